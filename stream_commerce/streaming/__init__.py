"""Replay-safe batch tables and the streaming jobs that write them."""
