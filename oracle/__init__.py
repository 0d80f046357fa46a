"""DuckDB oracle texts for the correctness gate (test side, not the engine)."""
