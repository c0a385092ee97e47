"""DataFrame operators: dedup, typing, joins, reshape, calendar, gold, quality."""
