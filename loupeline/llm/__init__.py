"""Operators for preparing language-model training data, one module each; ``queries`` binds them to the given tables."""
