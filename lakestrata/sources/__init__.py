"""Readers: the landing archive of hourly JSON files."""
