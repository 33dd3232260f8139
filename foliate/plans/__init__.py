"""Registered queries and their reference SQL."""
