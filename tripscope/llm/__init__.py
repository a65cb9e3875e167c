"""Operators of a training-data pipeline over the ``documents``, ``pages``
and ``labels`` tables.  Nothing outside this folder imports it."""
