"""DataFrame-to-DataFrame operators of the three layers."""
