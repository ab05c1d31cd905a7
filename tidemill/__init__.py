"""tidemill: a Spark-first engine that turns messy web payloads into gated, delivery-ready datasets."""
