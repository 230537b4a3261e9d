"""Order-event analytics on Spark: ingest, dedup, enrich, aggregate, observe."""
