"""Ocean-observation analytics as Spark DataFrame operators and jobs."""
