"""gondola: a Spark-native price lake for retail shelf observations."""
