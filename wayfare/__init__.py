"""Trip-record analytics on Spark: summaries, serving queries, merges and streams."""
