"""Operators for large-scale training data: extraction, fingerprints, search,
archives, mixing, near-duplicates, tokens, URL rules, toxicity, quality.

Nothing else in the library imports this subpackage.
"""
