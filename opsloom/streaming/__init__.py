"""Continuous scoring of request rows."""
