"""Feature preparation, training and scoring with Spark ML."""
