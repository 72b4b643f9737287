"""Structured Streaming over the admit/discharge/transfer feed."""
