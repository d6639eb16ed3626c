"""Readers of record files and stored service payloads."""
