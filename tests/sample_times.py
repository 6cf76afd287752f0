"""Fixed times of the test data."""

BASE = 1700000000000
