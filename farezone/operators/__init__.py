"""DataFrame operators: filters, joins, aggregations, zones, reshape, sorts."""
