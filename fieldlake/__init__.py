"""Farm, weather-station and climate analytics expressed as Spark jobs."""
