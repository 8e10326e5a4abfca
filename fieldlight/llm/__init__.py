"""Training-data operators: thirteen operators over the corpus tables, each in a module of its own."""
