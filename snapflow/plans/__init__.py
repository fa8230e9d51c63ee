"""Job specs, run log and the derived data sets."""
