"""Sources and sinks: table scans, the driver-table binding, the golden fixture."""
