"""Landing tables, source configuration and artifact storage."""
