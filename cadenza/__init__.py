"""Endurance-training and daily-health analytics for many athletes, as Spark jobs."""
