"""Feature catalogue (C1-C92) and its registry."""
