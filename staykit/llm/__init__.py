"""Training-data operators over the tables documents, pages, benchmark and labels."""
