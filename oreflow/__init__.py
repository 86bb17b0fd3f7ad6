"""oreflow: medallion pipelines, versioned Parquet tables and event-time features on Spark."""
