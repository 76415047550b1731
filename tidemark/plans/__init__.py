"""Multi-step plans built from the operators, and the registered queries."""
