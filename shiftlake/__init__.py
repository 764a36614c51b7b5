"""Equipment-telemetry operators and jobs for Spark."""
