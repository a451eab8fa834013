"""Readers and writers of vector layers, feature services and elevation tiles."""
