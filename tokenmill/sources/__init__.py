"""Scans and sinks: named tables with split partitions, JSON lines, binary
files, list files, prepared datasets, logs and metrics records."""
