"""Training-data operators: counting, formatting, cleaning, joining and writing texts."""
