"""cairnflow: a PySpark-native engine for location records, ordered observations and spatial networks."""
