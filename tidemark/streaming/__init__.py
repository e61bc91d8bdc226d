"""Structured Streaming jobs: DAU stream, change-record router, progress, CLI."""
