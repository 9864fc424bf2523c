"""Trip-record lakehouse jobs on Spark: enrichment, bronze, silver, checks and gold."""
