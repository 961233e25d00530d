"""Readers, the test-table binding and the table sinks."""
