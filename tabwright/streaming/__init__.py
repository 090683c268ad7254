"""Structured Streaming forms of the monitoring and feature operators."""
