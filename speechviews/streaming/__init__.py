"""Live counters from message streams."""
