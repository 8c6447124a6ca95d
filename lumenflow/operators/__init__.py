"""Pure DataFrame -> DataFrame operators."""
