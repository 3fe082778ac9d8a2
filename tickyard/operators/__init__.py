"""Operators over trade and bar frames: bars, dedupe, keyed tables, reads, metrics."""
