"""Conversation-to-knowledge analytics on Spark: DataFrame operators, sources, functions, plans and streams."""
