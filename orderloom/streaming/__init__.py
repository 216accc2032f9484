"""Change data, events and metrics, in batch form and as Structured Streaming."""
