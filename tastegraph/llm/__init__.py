"""Training-data pipeline operators: each module is one operator, `queries` registers them."""
