"""Column helpers and relational building blocks shared by the operators."""
