"""Sinks: staged delivery, records, workbooks."""
