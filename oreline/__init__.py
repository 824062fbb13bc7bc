"""oreline: layered (bronze, silver, gold) tables and star-schema measures on PySpark."""
