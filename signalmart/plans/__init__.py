"""Compositions of operators: the marts, the medallion build, the driver-table
feeds and the query registry."""
