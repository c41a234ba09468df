"""DataFrame operators over notifications and the tables made of them."""
