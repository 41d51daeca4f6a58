"""Pipelines: the operators composed into layers, each with a pure part and a part that writes tables."""
