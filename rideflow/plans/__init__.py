"""The three end-to-end jobs: preprocessing, live demand, model training."""
