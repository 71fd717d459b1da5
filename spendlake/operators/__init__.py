"""DataFrame-to-DataFrame operators: projection, filters, reports, joins, upsert, audits."""
