"""Input tables and report sinks."""
