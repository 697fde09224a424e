"""Readers and writers: files, databases, paged APIs, lake folders, sinks."""
