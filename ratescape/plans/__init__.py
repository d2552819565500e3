"""Multi-step jobs: canned queries and the batch ingest."""
