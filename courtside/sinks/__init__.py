"""Sinks: landing writer, processed-table writer, manifest, result files."""

from courtside.sinks.files import land_all, land_snapshot, save_result, write_processed

__all__ = ["land_all", "land_snapshot", "save_result", "write_processed"]
