"""Readers, snapshot tables and layer sinks."""
