"""A PySpark-native engine for place corpora, road graphs and training data."""
