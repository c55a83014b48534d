"""Column expressions and time-range arguments (no Spark actions)."""
