"""Fixture tables, registered queries and the SQL each is held against."""
