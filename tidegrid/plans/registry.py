"""The registered queries and, where SQL can express them, their SQL twins."""

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a `(spark, folder) -> DataFrame` under its own name."""

    def add(function):
        name = function.__name__
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add
