"""Retail event analytics, feature tables and model monitoring as Spark jobs."""
