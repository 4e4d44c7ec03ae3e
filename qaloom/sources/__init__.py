"""Readers, writers and resume joins."""
