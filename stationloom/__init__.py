"""Station-observation analytics expressed as Spark DataFrame plans."""
