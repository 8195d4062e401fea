"""Review analytics as Spark jobs: line cleaning, star schema, marts, data checks."""
