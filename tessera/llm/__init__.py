"""Training-data operators: near-dedup, packing, sharding, scoring and writing of text corpora.

Nothing else in the library imports this subpackage; it can be deleted whole.
"""
