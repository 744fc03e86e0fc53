"""Corpus operators for training-data pipelines: sharding, repeats, toxicity,
licences, packing, search, URL filters, near-duplicates and fingerprints.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing else in the library imports this subpackage.
"""
