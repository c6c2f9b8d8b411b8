"""Reading, parsing, landing and writing of raw records."""
