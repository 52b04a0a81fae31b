"""The tables of each layer, and the order in which a refresh builds them."""
