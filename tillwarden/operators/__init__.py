"""DataFrame operators: conforming, joins, totals, sequences, rules, audit."""
