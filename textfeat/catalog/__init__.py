"""Registered queries and their SQL counterparts."""

from textfeat.catalog import cleaning, corpus, features, learning, subjects

_MODULES = (cleaning, corpus, features, subjects, learning)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
