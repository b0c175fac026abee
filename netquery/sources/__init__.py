"""Readers (IO1-IO4) and sinks (IO5-IO8)."""
