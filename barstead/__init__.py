"""Fixed-interval market time series as DataFrame operators and Structured Streaming jobs."""
