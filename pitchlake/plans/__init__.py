"""Composite plans: the feature pipeline and the registered queries."""
