"""The row-by-row stages on a stream."""
