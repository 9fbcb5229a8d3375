"""The checks, one module per family, and the pieces they are built from."""
