"""Readers, parsers and validators."""
