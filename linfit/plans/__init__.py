"""Model search and the end-to-end jobs."""
