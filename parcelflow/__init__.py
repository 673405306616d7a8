"""Property-sale analytics on Spark: text extracts, cleaning, star schema, marts."""
