"""Training-data operators: mixing, chat formatting, sharding, scoring, search, rules, joins, encoding."""
