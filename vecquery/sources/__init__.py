"""Reading tables and keeping intermediate ones."""
