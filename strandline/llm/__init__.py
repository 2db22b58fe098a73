"""Operators for training-data pipelines: quality, dedup, decontamination, packing, scoring.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
only when the folder is there.
"""
