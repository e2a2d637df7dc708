"""Reading tables, databases and files, and writing results."""
