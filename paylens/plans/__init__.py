"""Plan assembly: the workspace (bound tables + persisted store), the query
registry and the DuckDB oracle texts used by the correctness gate."""
