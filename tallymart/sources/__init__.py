"""Scans of raw trees, catalogues and boundaries; sinks of archives, marts and logs."""
