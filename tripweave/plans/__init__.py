"""Operators put together: the daily build, the feature build, training, and the registered queries."""
