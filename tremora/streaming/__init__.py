"""The three continuous jobs and the keyed tables they keep."""
