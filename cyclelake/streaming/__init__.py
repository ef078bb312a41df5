"""Structured Streaming jobs that give the batch results continuously."""
