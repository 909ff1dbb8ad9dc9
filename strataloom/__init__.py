"""strataloom: a text-corpus engine on PySpark."""
