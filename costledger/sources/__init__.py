"""Scans: delimited files, raw sheets, file choice, fingerprints and row numbers."""
