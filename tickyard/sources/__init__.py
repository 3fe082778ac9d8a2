"""Inputs: the table reader and adapters from the given tables to the trade frame."""
