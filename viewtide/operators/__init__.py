"""DataFrame -> DataFrame steps from messages to star tables."""
