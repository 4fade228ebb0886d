"""weir: stream and table operators as Spark DataFrame transformations."""
