"""Query catalogue: named plans over the shared tables (`catalogue`) and
their ANSI-SQL equivalents for DuckDB (`oracle`)."""
