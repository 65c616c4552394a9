"""Timeline analytics on Spark: notes to relation tables and timelines."""
