"""Readers of the landing zone and of run-dated stages."""
