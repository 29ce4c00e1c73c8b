"""Territorial credit analytics as DataFrame and Structured Streaming operators."""
