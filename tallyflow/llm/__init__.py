"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage; the driver entry adds its
queries only when it can be imported. Each module holds one operator;
``queries.py`` registers the thin ``opN_<name>`` queries and ``oracle.py`` the
SQL of those that SQL can express.
"""
