"""Readers and writers of the monthly files and tables."""
