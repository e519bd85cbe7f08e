"""Statistical tests as grouped Spark aggregations."""
