"""Reading operational tables and payloads; keeping the target tables."""
