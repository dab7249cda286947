"""Operators for preparing language-model training data. Nothing else in chatloom imports this subpackage."""
