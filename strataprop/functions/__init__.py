"""Column expressions, argument checks and session facts shared by the operators."""
