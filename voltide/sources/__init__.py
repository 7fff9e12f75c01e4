"""Readers, writers and file management."""
