"""The table of named queries."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a function of (spark, sf_dir) under a name, with its oracle SQL if it has one."""
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add
