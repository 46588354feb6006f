"""File sources and ingest conformance."""
