"""Operators for building language-model training data, one module each.

Nothing outside this package imports it.  Every operator takes and returns
DataFrames; Python runs only inside Arrow-batched tasks, and whatever has to
be read twice is written to the folder that ``spark.checkpoint.dir`` names.
"""
