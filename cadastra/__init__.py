"""A Spark-native engine for screening land parcels."""
