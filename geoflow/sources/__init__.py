"""File and database formats."""
