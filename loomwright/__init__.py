"""Loomwright: a Spark-native engine for building and auditing edit-training data."""
