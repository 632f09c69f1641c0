"""Sources and sinks: landing JSON, seed CSV, table store, retention."""
