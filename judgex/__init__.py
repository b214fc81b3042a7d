"""judgex: a PySpark-native engine for annotating documents and building training data."""
