"""Analytics for two-player contests, market snapshots and symbol mentions on Spark."""
