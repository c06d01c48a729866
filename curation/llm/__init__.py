"""Operators for preparing language-model training data.

Nothing else in the library imports this package; general helpers are
imported from the library."""
