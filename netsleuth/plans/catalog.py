"""All registered queries and their SQL twins."""

from netsleuth.plans import (causal_queries, corpus_queries, flow_queries, graph_queries, io_queries, model_queries,
                             stream_queries)

FAMILIES = [flow_queries.FAMILY, causal_queries.FAMILY, graph_queries.FAMILY, corpus_queries.FAMILY,
            model_queries.FAMILY, stream_queries.FAMILY, io_queries.FAMILY]


def queries():
    return {name: fn for family in FAMILIES for name, fn in family.queries.items()}


def oracle_sql():
    return {name: sql for family in FAMILIES for name, sql in family.oracles.items()}
