"""Plans: staging, warehouse, analytics, ingestion and the pipeline."""
