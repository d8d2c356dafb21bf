"""Production-quality decision support as Spark DataFrame transformations."""
