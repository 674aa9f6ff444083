"""Trip analytics on Spark: cleaning, enrichment, zone, payment, sharing and
anomaly analyses, each a plain ``DataFrame -> DataFrame`` function."""
