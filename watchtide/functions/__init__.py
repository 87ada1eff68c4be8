"""Column-level helpers shared by every job."""
