"""Sessions, shared tables, registered queries and their SQL."""
