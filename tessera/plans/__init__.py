"""Stand-in fixtures and the query catalogue (Spark plans + oracle SQL)."""
