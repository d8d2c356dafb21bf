"""Column-level building blocks; nothing here triggers a job."""
