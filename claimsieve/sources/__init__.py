"""Where the data lies, what it looks like and how it is read."""
