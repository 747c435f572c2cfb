"""Text-safety, evaluation and retrieval-audit analytics as Spark DataFrames."""
