"""Operators for large-scale training-data pipelines (one module per operator).

Nothing else in the library imports this package.  ``registry.QUERIES`` holds the
registered queries; ``registry.ORACLES`` their DuckDB SQL where SQL can state them.
"""
