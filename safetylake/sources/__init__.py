"""Sources and sinks: JSON bronze ingest, page landing, and the test feeds derived from the driver tables."""
