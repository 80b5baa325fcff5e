"""Reading and writing tables, reports and holiday payloads."""
