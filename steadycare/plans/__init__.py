"""The two jobs: features and model for the whole population, and scores for requested patients."""
