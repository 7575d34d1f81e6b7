"""Layer jobs: read, transform, write, report counts."""
