"""Column expressions shared by the stages."""
