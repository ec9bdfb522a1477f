"""Sources and sinks: delimited text, carved grids, Parquet and CSV output."""
