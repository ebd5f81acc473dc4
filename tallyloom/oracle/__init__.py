"""DuckDB statements that check the registered queries."""
