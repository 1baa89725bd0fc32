"""End products: functions from input tables (and a clock) to a result DataFrame."""
