"""SQL that a second engine runs on the same tables to check the queries."""
