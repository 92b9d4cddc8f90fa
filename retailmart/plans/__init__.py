"""The star schema and everything computed from it."""
