"""Subscriber-attrition analytics as Spark DataFrame and MLlib jobs."""
