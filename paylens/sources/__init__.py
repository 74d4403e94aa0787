"""Sources (table scans, role bindings, the second revenue source) and sinks."""
