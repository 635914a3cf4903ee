"""Endpoint-detection lakehouse as plain DataFrame-to-DataFrame functions on Spark."""
