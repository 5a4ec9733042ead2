"""DataFrame in, DataFrame out: nesting, access, change, quality, validation and profile operators."""
