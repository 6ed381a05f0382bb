"""Readers and writers: landing files, topics, simulation XML, map XML, weather, layer tables."""
