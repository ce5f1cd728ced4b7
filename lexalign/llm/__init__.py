"""Operators for training-data pipelines: one module per operator, registered queries in ``queries``.

Nothing else in the package imports this subpackage.
"""
