"""Change-data analytics on Spark: decoded row changes, append-only change logs
under three table semantics, and the current state answered from them."""
