"""Batch flow, semantic layer, dashboard and the query catalog."""
