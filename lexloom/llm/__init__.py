"""Operators for preparing large text corpora for training.

Every module is self-contained: an operator with a general interface, and a
thin query (``opN_*``) in :mod:`.queries` that runs it over a whole table with
production parameters.
"""
