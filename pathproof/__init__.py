"""Location-integrity analytics for delivery fleets, as Spark DataFrame jobs."""
