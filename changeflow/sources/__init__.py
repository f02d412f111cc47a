"""Sources: queue scans and envelopes, layer tables, capture files, and the
replay of the driver's test tables as a stream of change events."""
