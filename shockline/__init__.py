"""Event-time market-shock analytics as Spark DataFrame transforms, for batch and streams alike."""
