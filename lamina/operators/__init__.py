"""DataFrame-to-DataFrame operators: masking, dedup, joins under skew, upsert, linkage."""
