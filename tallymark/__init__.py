"""Spark jobs that reconcile commerce and logistics reports."""
