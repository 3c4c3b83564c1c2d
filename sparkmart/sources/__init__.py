"""Reading sources and writing zones."""
