"""Tidemark: a telemetry event lake expressed as Spark jobs."""
