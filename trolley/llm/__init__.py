"""Operators for large text corpora: cleaning, searching, mixing and encoding documents."""
