"""Scalar functions: texts, JSON replies, settings."""
