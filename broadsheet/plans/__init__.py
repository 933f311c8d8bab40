"""Ready plans over a folder of tables, and the SQL they are checked against."""
