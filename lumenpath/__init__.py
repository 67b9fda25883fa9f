"""lumenpath: a Spark-native engine that turns learning material into a validated topic graph."""
