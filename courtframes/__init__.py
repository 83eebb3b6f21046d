"""courtframes: tracking-data analytics as Spark jobs."""
