"""Operators over logs and their metadata: DataFrame in, DataFrame out."""
