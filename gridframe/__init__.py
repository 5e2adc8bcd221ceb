"""Group-and-entry result data on Spark: checks, audits, as-of features, snapshots, probability scores."""
