"""Business tables (gold layer) and the whole-pipeline run."""
