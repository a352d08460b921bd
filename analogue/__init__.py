"""The reports run on the driver's tables: derived relations, queries and check SQL."""
