"""Readers of the raw inputs, the weather payload, the result store and the
fixture views over the driver tables."""
