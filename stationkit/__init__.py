"""Station-readings analytics as plain PySpark DataFrame functions."""
