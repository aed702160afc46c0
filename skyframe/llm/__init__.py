"""Training-data operators: quality and toxicity scoring, fingerprints,
near-duplicates, repeated passages, secret scans, mixing, tokenising,
nearest neighbours and sharding.  Nothing else in the library imports this
subpackage."""
