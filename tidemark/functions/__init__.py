"""Type mapping, conversion and text rendering as column expressions."""
