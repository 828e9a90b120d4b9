"""Discovery, catalog registration, scans and external sinks."""
