"""barframe.streaming."""
