"""The end-to-end jobs and their command line."""
