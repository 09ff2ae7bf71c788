"""The row-wise operators applied to file streams."""
