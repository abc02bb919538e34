"""quire: DataFrame operators for text-corpus ranking, question/answer
scoring with integer k-means, and wide survey summaries on Spark."""

__all__ = ["functions", "operators", "sources", "plans"]
