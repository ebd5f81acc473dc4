"""Reports: operators put together over input tables."""
