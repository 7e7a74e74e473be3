"""Readers and writers for the tables and the message stream."""
