"""Reading and writing tables, and the order-line relation."""
