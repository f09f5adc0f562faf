"""Column expressions: text, time of day and season, message keys, display formats."""
