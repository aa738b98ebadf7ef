"""Trip analytics as Spark jobs: ingest, clean, enrich, aggregate, stream and model city trip records."""
