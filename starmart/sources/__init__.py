"""Inputs and table I/O: the test-table fixture, NDJSON/Kafka record parsing,
snapshot publishing of lake tables."""
