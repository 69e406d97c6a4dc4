"""Monthly credit-risk data work on Spark: snapshots, labels, features, scores, monitoring."""
