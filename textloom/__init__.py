"""textloom: a PySpark-native engine for building, searching and evaluating text corpora."""
