"""Readers and writers of the study's files and tables."""
