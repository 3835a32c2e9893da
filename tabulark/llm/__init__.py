"""Training-data operators: ten corpus operators, each in a module of its own."""
