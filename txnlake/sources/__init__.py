"""Sources and sinks: raw CSV feed, processed tables, test-table adapter."""
