"""Plumbline: takeoff and estimate analytics as Spark jobs."""
