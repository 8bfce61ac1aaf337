"""Structured Streaming jobs: the batch operators applied to unbounded inputs."""
