"""Column helpers on edge tables and values."""
