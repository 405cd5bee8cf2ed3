"""PySpark-native lakehouse jobs for messy product catalogues."""
