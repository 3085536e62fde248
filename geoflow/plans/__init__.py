"""Registered queries and the layers they run on."""
