"""Sources and sinks: table loading, fixture views, text logs, change records."""
