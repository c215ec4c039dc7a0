"""Column helpers and joins, windows and numbering that hold up under skew."""
