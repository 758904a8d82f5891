"""Training-data operators over whole document tables. Nothing else in the library imports this."""
