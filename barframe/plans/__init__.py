"""barframe.plans."""
