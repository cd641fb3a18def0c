"""Operators for training-data pipelines over document tables.

Each module holds one operator; ``queries`` registers them over the driver's tables. Nothing
outside this subpackage imports it.
"""
