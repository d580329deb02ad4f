"""Entity features, out-of-fold boosting and null-importance selection as Spark jobs.

Every operator takes and returns DataFrames.  Nothing data-sized passes through
the driver; the few eager reads are bounded metadata (bucket bounds, vocabularies,
quantile edges, column ranges).
"""
