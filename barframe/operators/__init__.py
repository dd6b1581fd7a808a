"""barframe.operators."""
