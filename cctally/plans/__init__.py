"""User-level jobs (L1-L9) and the driver's query catalogue."""
