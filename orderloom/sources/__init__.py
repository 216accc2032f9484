"""Reading and writing tables, databases, topics, change logs and text logs."""
