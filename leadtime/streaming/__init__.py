"""Monitoring of prediction events; every function takes a batch or a streaming DataFrame."""
