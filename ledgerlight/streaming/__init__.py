"""The event feed as a stream, a churn monitor and source freshness."""
