"""Structured Streaming: file streams, ledgered exactly-once sinks, watermark dedupe, upload triggers."""
