"""Jobs over data that arrives over time."""
