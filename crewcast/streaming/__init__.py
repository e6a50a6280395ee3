"""File-drop ingestion with Structured Streaming."""
