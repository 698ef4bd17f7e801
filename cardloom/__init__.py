"""cardloom: a PySpark-native engine for records read from scanned cards, and for the registry built from them."""

__version__ = "0.1.0"
