"""Operators on training text: cleaning, matching, search and mixing."""
