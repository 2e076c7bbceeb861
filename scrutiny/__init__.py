"""PySpark jobs for versioned polling-station tallies and similar snapshot data."""
