"""Training-data operators: ten corpus-scale tools over a ``documents``-shaped table.

Nothing else in the library imports this package.
"""
