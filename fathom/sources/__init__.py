"""Sources and sinks: declared schemas in, lazy DataFrames out."""
