"""Structured Streaming operators (SS1-SS7) and stream runners."""
