"""DataFrame operators: each takes and returns DataFrames and leaves planning to Catalyst."""
