"""Inputs and sinks: the race-results fixture, CSV scans, table writes."""
