"""Vehicle telemetry on Spark: decode, enrich, alert and count, in batch and on streams."""
