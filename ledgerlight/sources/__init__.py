"""Raw table schemas, readers and the feed derived from the test tables."""
