"""Models built from operators, and the layers they write to."""
