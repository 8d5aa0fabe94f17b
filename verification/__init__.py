"""Every operator as a query on the given tables, and the SQL that must give the same rows."""
