"""Reading and writing tables, models and the model registry."""
