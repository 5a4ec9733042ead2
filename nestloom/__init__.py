"""Turn normalized tables into keyed, nested document tables with Spark, and keep them in step."""
