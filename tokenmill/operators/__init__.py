"""DataFrame -> DataFrame operators.

``offsets`` (global positions, running offsets, two-level buckets),
``records`` (projections, filters, record formatting), ``sample``
(ordering, sampling, splits), ``tokens`` (tokens, vocabulary, padding,
masks, packing, calibration windows), ``rewards`` (rewards, preference
pairs, group statistics), ``metrics`` (aggregations and evaluation
metrics), ``retrieval`` (exact top-k retrieval and IR metrics, batching
for contrastive training), ``runs`` (option grids, steps, cost).
"""
