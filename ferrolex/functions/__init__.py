"""Part of ferrolex."""
