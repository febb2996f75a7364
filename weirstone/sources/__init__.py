"""Everything that reads or writes outside a DataFrame."""
