"""Reading the seven source tables, writing marts."""
