"""larder: kitchen production and waste analytics as plain PySpark."""
