"""Live versions of the run-log operators."""
