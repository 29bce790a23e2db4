"""Sources and sinks: landed payloads, station lists, observation files, adapters."""
