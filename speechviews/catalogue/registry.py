"""Where queries and their SQL are collected."""

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its name, with its SQL."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register
