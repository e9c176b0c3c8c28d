"""DataFrame operators of the identity model."""
