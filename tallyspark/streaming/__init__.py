"""Structured Streaming delivery of the landing job."""
