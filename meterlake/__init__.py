"""meterlake: a PySpark-native medallion library for meter-style time series."""
