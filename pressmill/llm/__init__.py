"""Training-data operators: extraction, fingerprints, dedup, classifiers, PII, packing, tokenizing.

Each module holds one operator with a general interface and, as ``opN_*`` functions, the thin queries
that derive the registered digest columns from it. ``registry`` lists those queries and their SQL.
"""
