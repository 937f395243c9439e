"""Column-to-column helpers: every one is a native, code-generated expression."""
