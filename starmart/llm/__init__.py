"""Training-data operators: tokenisation, search, deduplication, archives,
classifiers, licence scans and source mixing, each a Spark job of its own."""
