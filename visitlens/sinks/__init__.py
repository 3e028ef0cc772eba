"""Writers: JSON lines, JDBC, upserted tables and the console."""
