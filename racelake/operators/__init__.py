"""Generic DataFrame operators: filters, joins, aggregates, dedup, sort/top-k."""
