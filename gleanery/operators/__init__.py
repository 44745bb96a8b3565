"""Table operators. Each takes and returns DataFrames and stays lazy unless its docstring says otherwise."""
