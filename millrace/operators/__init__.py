"""DataFrame operators: skew profiling, joins, numbering, sampling, parsing, layout advice."""
