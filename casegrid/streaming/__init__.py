"""The row-by-row cleaning steps on a file stream."""
