"""Authentication-event analytics expressed as Spark DataFrame plans."""
