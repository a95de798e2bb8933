"""textmill: a PySpark-native engine for preparing text corpora for language-model training."""
