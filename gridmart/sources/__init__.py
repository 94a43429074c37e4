"""Reading raw tables, landed files and literal dimensions; writing tables and views."""
