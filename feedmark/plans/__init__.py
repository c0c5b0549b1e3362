"""Pipelines and registered queries."""
