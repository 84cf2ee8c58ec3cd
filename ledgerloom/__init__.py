"""Retail-ledger and near-duplicate-notice analytics as plain Spark DataFrame jobs."""
