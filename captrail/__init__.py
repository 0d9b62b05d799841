"""captrail: web-archive capture analytics expressed as Spark DataFrame plans."""
