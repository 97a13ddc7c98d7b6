"""Reading and writing tables and folders."""
