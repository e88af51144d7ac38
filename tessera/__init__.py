"""tessera: corpus preparation and analytics on PySpark."""
