"""Spark-native extract and load: incremental scans, text-form codecs, file and JDBC sinks, merges and delivery."""
