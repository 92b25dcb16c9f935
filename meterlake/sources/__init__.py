"""Readers, payload parsers, landing writers and the shared staging folder."""
