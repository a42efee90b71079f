"""Flood-depth pixel analytics as Spark jobs: layer alignment, sampling, boosted
regression, scoring and grouped evaluation, all on DataFrames."""
