"""Readers and writers: vendor feeds, event logs, outbox and cursor tables, test adapters."""
