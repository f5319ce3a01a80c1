"""Every operator as a query over the supplied tables, and the same query in plain SQL."""
