"""DataFrame operators: latest-per-key, ranking, joins, pairing, headers, reshaping, retention, samplesheets."""
