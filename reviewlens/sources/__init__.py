"""Readers for raw and tabular inputs, and the table writers."""
