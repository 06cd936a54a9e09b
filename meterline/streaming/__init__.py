"""Ingest of months as their files arrive."""
