"""furrow: a Spark-first engine for market price feeds, data audits and repairs."""
