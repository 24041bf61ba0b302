"""Readers, writers and the incident records derived from an event table."""
