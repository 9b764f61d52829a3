"""Composed jobs: bronze ingest, silver split, gold reports, comments and languages."""
