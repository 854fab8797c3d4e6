"""Table operators: windows, joins, reports, metrics, splits, features, ML, validation."""
