"""File sources and sinks: CSV visits/person, encodings, manifest, Parquet, metrics."""
