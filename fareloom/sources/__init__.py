"""Readers for raw, bronze, silver, gold, zone and weather data."""
