"""Table steps: DataFrame -> DataFrame, lazy unless the docstring says otherwise."""
