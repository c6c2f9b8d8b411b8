"""DataFrame -> DataFrame building blocks; every column name is an argument."""
