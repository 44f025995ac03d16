"""Scans of readings, deployments and stored tables, and the write side."""
