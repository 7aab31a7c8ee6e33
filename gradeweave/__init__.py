"""Grade-report and room-planning analytics on Spark DataFrames."""
