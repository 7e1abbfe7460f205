"""Tables kept as a series of committed versions."""
