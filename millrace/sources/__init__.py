"""Scans and sinks: files, CSV, catalog tables, chunked exports, JDBC."""
