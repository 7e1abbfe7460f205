"""Named reports, and the queries registered on the test tables."""
