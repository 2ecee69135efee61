"""A place for a family's queries and their SQL twins."""


class Family:
    def __init__(self):
        self.queries, self.oracles = {}, {}

    def register(self, name, sql=None):
        """Decorator: keep ``fn(spark, folder) -> DataFrame`` under ``name`` with its SQL twin."""
        def keep(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn
        return keep
