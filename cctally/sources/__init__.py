"""Readers (S1-S16) and sinks (K1-K5)."""
