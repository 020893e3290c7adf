"""reelrank: rating features, hot lists, click model and recommendations on Spark."""
