"""Registered queries over the driver tables and the DuckDB SQL they are compared with."""
