"""barframe.functions."""
