"""Sinks: layer writers, catalog registration, envelope files, path helpers."""
