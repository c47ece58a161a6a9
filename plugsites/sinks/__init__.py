"""Stage tables, exports and the warehouse load."""
