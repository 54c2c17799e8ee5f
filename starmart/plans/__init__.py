"""Composite dataflows: silver, marts, the registered queries and the runner."""
