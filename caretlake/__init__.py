"""caretlake: Spark-native building of code-completion and text-corpus datasets."""

__version__ = "0.1.0"
