"""A PySpark-native engine for document ingestion, text analytics and training-data preparation."""
