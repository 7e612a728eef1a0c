"""Ordered pipelines over the operators."""
