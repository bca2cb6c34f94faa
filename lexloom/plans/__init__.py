"""Named queries over the test tables, with the SQL that a second engine runs."""
