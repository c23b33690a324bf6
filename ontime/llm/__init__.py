"""Training-data operators: dedup, scoring, filtering, tokenization and mixing.

Nothing outside this subpackage imports it.
"""
