"""Tables, record streams and dictionaries to read from and write to."""
