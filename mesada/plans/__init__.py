"""The reports, composed from the operators."""
