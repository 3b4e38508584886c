"""Sources and sinks: test tables and shop adapters, text lines, table and text writers."""
