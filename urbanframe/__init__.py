"""urbanframe: a PySpark-native engine for urban geospatial tables."""
