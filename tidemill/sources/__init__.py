"""Files and tables: discovery, scans, contracts, sinks."""
