"""DataFrame -> DataFrame operators, from staging to quality checks."""
