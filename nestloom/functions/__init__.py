"""Column-level helpers: keys, sparse attributes, typed encoding, cleaning."""
