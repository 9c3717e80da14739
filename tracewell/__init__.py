"""Telemetry processing on Spark: shape, redact, validate, budget, batch and reconcile records."""

__all__ = ["contracts", "schemas", "session"]
