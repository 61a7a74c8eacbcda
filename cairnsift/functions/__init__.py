"""Column functions: name reading, text, digests and policy values."""
