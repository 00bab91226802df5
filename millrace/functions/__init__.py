"""Column-level helpers: time units, text splitting, parsing, rendering."""
