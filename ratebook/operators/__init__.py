"""DataFrame -> DataFrame operators.

rates    quote mids, target mids, cross rates, union, self-pair filter, rare grid
enrich   reference snapshot, left enrichment with defaults, known pairs, scaling
layouts  ERP (M/V) and keyed-rate layouts, rate-type guard
quality  guards (empty, completeness, invalid rate, NOT NULL, V collisions), run counts
merge    keyed upsert (MERGE semantics) as one partial aggregate
records  selection ranges, call metrics, typed fields, nested tables
"""
