"""Spark-first analytics for episodic, time-ordered, vector-valued tables."""
