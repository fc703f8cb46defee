"""A PySpark-native engine for public political-money filings: ingest, entity resolution, analytics."""
