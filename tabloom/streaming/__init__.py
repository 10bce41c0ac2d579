"""Fitted pipelines over streams."""
