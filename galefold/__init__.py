"""Weather-observation analytics and corpus preparation on Apache Spark."""
