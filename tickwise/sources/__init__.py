"""Sources: table scans, tick-store scans, seed loads, streams, test-table adapters."""
