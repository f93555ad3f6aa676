"""spark-submit entry points: ingest, preprocess, train, evaluate, score, profile."""
