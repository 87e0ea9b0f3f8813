"""pawprint: PySpark-native preparation, profiling and classification of tabular records."""

__version__ = "0.1.0"
