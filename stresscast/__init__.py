"""stresscast: Spark-native operational-risk analytics over daily energy series."""

__version__ = "0.1.0"
