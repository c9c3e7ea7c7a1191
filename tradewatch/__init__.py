"""Trade surveillance on Spark: ingest, baselines, anomaly alerts, notification queue, debate accounts."""
