"""The daily jobs and the log of their runs."""
