"""Sources and sinks: driver parquet tables, validated CSV loaders, JSON, registry."""
