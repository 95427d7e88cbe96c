"""Scans: files, landing folders, streams and dead letters."""
