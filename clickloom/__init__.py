"""clickloom: clickstream quality, sessions, attribution and monitoring as Spark DataFrame jobs."""
