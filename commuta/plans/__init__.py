"""Report tables and multi-step builds composed from the operators."""
