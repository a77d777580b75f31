"""Operations of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``labels``.

One module per operator, ``queries`` with the registered queries and their SQL.
Nothing else in the library imports this package.
"""
