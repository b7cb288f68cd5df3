"""presslens: a PySpark-native engine for finding, deduplicating and auditing news mentions."""
