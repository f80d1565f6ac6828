"""Column expressions: no data access, no Python UDF."""
