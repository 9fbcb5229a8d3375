"""Whole runs: families over tables and over months."""
