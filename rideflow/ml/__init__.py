"""Spark ML features, models, clustering and scoring."""
