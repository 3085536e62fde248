"""Operators on tables and layers."""
