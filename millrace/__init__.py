"""millrace: a PySpark-native engine for curating and analysing trajectory, code and text corpora."""
