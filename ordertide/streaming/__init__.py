"""The two long-running queries and the helper that starts them."""
