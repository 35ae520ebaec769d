"""Operators for training-data corpora: filtering, near-copies, secrets, packing and archives.

Nothing outside this package imports it. Every operator takes and returns
DataFrames; Python runs only inside tasks, over Arrow batches.
"""
