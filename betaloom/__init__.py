"""betaloom: a Spark-native engine for methylation biomarker analytics."""

__version__ = "0.1.0"
