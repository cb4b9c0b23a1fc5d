"""Composite jobs: load-enrich-store ETL, change tracking, enrichment round trips."""
