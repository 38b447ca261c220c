"""Column helpers and small statistics shared by the operators."""
