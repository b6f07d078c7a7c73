"""Inputs and outputs: fixture mapping, look-up tables, versioned target."""
