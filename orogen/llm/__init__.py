"""Training-data operators: one module per operator, `registry` lists their queries."""
