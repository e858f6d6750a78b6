"""The registered queries over the retail tables and the SQL each one is checked against."""
