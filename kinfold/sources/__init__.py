"""Reading and writing tables, value labels and stored predictions."""
