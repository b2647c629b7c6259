"""inkmill: a PySpark-native engine that turns raw text sources into clean, structured corpora."""
