"""loomspan: entity-linking data preparation and training-data operators on PySpark."""
