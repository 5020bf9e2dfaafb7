"""Operators for preparing training text at scale.

One module per operator; :mod:`mdmspark.llm.queries` registers a thin query
for each. Nothing else in the library imports this package.
"""
