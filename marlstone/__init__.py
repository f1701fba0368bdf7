"""A PySpark-native engine for filing metrics, with large-corpus text operators in ``marlstone.llm``."""
