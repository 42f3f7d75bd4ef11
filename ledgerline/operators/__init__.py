"""Record-level and key-level steps: DataFrame in, DataFrame out."""
