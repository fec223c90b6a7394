"""DuckDB SQL that answers each query independently of the Spark code."""
