"""tablewarden: data-quality operators as lazy Spark DataFrame transformations."""
