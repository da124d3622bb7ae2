"""A Spark-native engine for curating and analysing e-mail and document corpora."""
