"""Table sources and sinks, and the forecast store."""
