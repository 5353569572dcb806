"""gleanery: a PySpark-native engine for mining structured records from text and page metadata."""
