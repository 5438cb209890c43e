"""Scans and sinks: tolerant CSV landing, table writes, snapshots and the
mapping of the driver's tables onto the funding domain."""
