"""DataFrame operators: edges and graph measures, joins, rules, rankings, profiles and merges."""
