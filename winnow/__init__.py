"""winnow: a PySpark-native engine that ranks and narrows large candidate pools."""

__version__ = "0.1.0"
