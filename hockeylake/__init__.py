"""Ice-hockey statistics as Spark DataFrame transformations."""
