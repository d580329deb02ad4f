"""Scans, archive staging and sinks."""
