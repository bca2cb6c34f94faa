"""Incremental forms of the batch operators, for sources that keep growing."""
