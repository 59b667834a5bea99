"""Telemetry staging on Spark: strict envelope parsing, aligned offset ranges, a
replay-safe staging sink with a commit ledger, and audits over what landed."""
