"""Column builders: parsers, classifiers, labels and keys (built-in expressions only)."""
