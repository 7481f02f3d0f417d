"""Document-corpus ingestion, duplicate detection and enrichment on Spark DataFrames."""
