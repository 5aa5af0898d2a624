"""Sales-event analytics on Spark: decode, deduplicate, aggregate, check and replay event logs."""
