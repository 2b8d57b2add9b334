"""Operators for preparing training data, each with a thin query over the given tables.

The modules ``opN_*`` hold one operator each; ``queries`` registers them. Nothing
outside this subpackage imports it.
"""
