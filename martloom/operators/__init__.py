"""Reusable DataFrame transforms shared by the marts."""
