"""The analyses run on the given benchmark tables, and the SQL they are checked against."""
