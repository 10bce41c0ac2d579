"""Reading and writing tables, learned state and models."""
