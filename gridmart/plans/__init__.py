"""Silver and gold models, report queries and the daily run."""
