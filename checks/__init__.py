"""Every operator as a query over the given test tables, with the SQL that must agree with it."""
