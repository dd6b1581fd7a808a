"""barframe.sources."""
