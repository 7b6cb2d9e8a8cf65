"""The registered queries, their input adapters and the SQL they are checked against."""
