"""Item builders for the document targets, and the runs that load them."""
