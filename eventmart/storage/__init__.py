"""Table layouts and replay-safe sinks."""
