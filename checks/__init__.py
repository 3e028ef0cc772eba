"""Every operator as a query over the given tables, next to the SQL it must agree with."""
