"""Name -> Spark job, and SQL where it can express the job."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add
