"""Solar-forecast data on Spark: every operator takes and returns DataFrames."""
