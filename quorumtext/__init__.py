"""quorumtext: Spark-native analytics for archives of multi-speaker, multilingual text."""
