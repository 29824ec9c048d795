"""Sources and sinks: driver tables, the posting fixture, CSV, warehouse tables."""
