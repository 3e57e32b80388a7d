"""Change-data analytics on Spark: change events in, current state, history and alerts out."""
