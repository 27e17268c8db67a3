"""Sources and sinks: adapter views over the supplied tables, raw landing
sources, and the fact-table writers / readers."""
