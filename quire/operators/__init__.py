"""Operators: each is a function DataFrame (+ parameters) -> DataFrame, lazy
unless its plan depends on a measure.

Jobs run while a plan is built in the k-means loop (one small aggregate per
round; the k centres come back to the driver), for the hot questions of a
pairing (one sketch), the range of a median's values, the size of a vocabulary
table, and for the reliable checkpoints (`clustering.materialize`, the first
stage of `articles.inverted_index_blocks`), which write to
`spark.checkpoint.dir`.
"""
