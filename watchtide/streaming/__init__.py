"""Continuous ingest, newest-copy store and monitors."""
