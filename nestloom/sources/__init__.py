"""Reading source tables, scratch space, and the stored targets."""
