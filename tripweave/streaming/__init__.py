"""Analyses of trips that are still arriving."""
