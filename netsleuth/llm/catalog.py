"""Queries and SQL twins of this subpackage, the pipeline among them."""

import corpus_pipeline
from netsleuth.llm.queries import FAMILY


def queries():
    return {**FAMILY.queries, "pipeline": corpus_pipeline.run}


def oracle_sql():
    twins = dict(FAMILY.oracles)
    if corpus_pipeline.ORACLE_SQL:
        twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return twins
