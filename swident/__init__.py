"""A PySpark-native engine for software-identity analytics."""
