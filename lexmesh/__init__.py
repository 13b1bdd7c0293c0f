"""lexmesh: a PySpark-native engine for governed vocabularies and their graphs."""
