"""A PySpark-native engine for posting intelligence and training-data pipelines."""
