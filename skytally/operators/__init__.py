"""DataFrame in, DataFrame out. Column names are arguments."""
