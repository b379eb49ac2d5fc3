"""Other data brought into the shape of the nine raw tables."""
