"""correlia: a Spark-native engine that turns a literature corpus into a relation network."""
