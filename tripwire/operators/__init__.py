"""DataFrame -> DataFrame operators; each works on batch frames, and on
streaming frames unless its docstring says otherwise."""
