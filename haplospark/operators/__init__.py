"""DataFrame-to-DataFrame operators of the report."""
