"""Plan shapes and multi-step jobs built from the operators."""
