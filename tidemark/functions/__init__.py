"""Column functions and schemas."""
