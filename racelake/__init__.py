"""racelake: a Spark-native lakehouse for messy race-result data.

Layers (each a plain DataFrame -> DataFrame function):

- ``sources``    raw inputs: the race-results fixture derived from the supplied
                 tables, CSV scans, table reads and sinks.
- ``functions``  Column builders (parsers, classifiers, labels, keys); built-in
                 Spark expressions only, no UDFs.
- ``operators``  generic DataFrame operators (filters, joins, aggregates, dedup,
                 sort/top-k).
- ``plans``      compositions: silver one-big-table, star schema, views, data
                 quality checks, profiling.
- ``streaming``  Structured Streaming ingest and the same silver chain on a stream.
"""

from racelake.session import get_session, lake_root

__all__ = ["get_session", "lake_root"]
