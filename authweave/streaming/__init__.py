"""The cleaning transform on a stream of staged files."""
