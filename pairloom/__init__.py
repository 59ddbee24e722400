"""A Spark-native engine for curating paired-edit datasets."""
