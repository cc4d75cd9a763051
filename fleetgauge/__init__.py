"""Fleet telemetry analytics on Spark: snapshot transforms, reporting views and repository jobs."""
