from fieldtally.sinks.writers import format_paths, write_paths_report, write_stream, write_table

__all__ = ["format_paths", "write_paths_report", "write_stream", "write_table"]
