"""DataFrame operators. All are lazy unless they say otherwise."""
