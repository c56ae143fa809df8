"""Property-sales star schema, data quality and serving queries as Spark jobs."""
