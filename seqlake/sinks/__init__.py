"""Sinks: table and CSV writers, distributed copy, processed-id ledger."""
