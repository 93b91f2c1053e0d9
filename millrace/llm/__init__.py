"""Operators of a training-data pipeline: one module per operator, its registered query in ``queries``.

Nothing outside this folder imports it.
"""
