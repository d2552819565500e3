"""DataFrame-to-DataFrame operators over the rate table."""
