"""Structured Streaming jobs: bronze to silver, silver to gold."""
