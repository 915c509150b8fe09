"""Spark-native document analytics: extraction, cleaning and structure parsing over tables of documents."""
