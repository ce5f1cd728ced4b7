"""End-to-end plans that chain the operators into one DataFrame plan each."""
