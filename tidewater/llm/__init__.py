"""Operators for large training corpora: counting, cleaning, matching, scoring, encoding and packing."""
