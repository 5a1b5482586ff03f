"""Whole jobs: landed payloads to the output table."""
