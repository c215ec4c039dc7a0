"""Operators over the order-line relation."""
