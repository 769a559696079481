"""Grid, time-axis, forecast, validation and adjustment operators."""
