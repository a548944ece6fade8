"""Sources and sinks: HTML tables, links, CSV supplement, table sets, JSON records."""
