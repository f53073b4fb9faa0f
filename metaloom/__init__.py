"""Dataset-metadata harvesting, checking and publishing as Spark DataFrame operators."""
