"""Every operator as a query on the test tables, and the SQL that checks it."""
