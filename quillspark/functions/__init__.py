"""Column-level functions: text, URLs, markup and record fields."""
