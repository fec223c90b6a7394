"""Reading, landing and registering farm data."""
