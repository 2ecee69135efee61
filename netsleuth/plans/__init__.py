"""Whole queries: operators composed over tables, with their SQL twins."""
