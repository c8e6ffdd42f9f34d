"""Composed dataflows: archive, ingest, star schema."""
