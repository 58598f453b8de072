"""A Spark-native engine for labelling titles and building vector datasets."""
