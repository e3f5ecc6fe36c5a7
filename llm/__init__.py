"""Training-data operators: ten operators, their registered queries and SQL."""
