"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Each module holds one
operator with a general interface; ``queries`` registers the thin queries."""
