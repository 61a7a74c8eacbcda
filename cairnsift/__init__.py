"""Spark-native operators for curating, planning and auditing file collections."""
