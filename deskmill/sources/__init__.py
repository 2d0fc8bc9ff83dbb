"""Readers and writers of workspace exports and of the plain tables."""
