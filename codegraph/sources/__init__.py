"""Readers of repositories and writers of bundles."""
