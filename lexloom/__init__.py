"""A PySpark-native engine for multi-source lexical datasets."""
