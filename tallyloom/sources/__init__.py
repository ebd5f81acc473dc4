"""Table reads and writes, and the views over the test tables."""
