"""Derived fixtures, the registered query catalog, its DuckDB oracle, and the
end-to-end flows."""
