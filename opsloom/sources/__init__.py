"""Readers, writers and the views that give driver tables their hospital shape."""
