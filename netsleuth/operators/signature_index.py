"""Approximate nearest vectors by an index of signature buckets.

A vector has one bucket in each of many tables: the signs of its products with a few
orthonormal planes. The index is the table (id, tbl, bucket). A query probes in every
table the buckets that differ from its own in the signs it was least sure of, the
cheapest flips first, and meets the index by an equi-join. Rows that share enough probed
buckets are its candidates, and only they are scored. Nothing here looks at a vector
that is no candidate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsleuth.session import durable, shuffle_width

#: Copies of a query when its candidates are scored or ranked, so that no task holds all of them.
SALTS = 32


@dataclass(frozen=True)
class Signature:
    """``tables`` buckets of ``bits`` signs; ``probes`` of a table's 2^bits buckets are visited,
    and a candidate is met in ``votes`` tables at least. Fewer votes and more probes find
    more and score more."""

    tables: int = 48
    bits: int = 12
    probes: int = 256
    votes: int = 6
    seed: int = 7

    def planes(self, dim: int):
        """(tables, bits, dim): orthonormal rows within a table, as far as the dimensions reach."""
        import numpy as np

        rng = np.random.default_rng(self.seed)
        out = []
        for _ in range(self.tables):
            drawn = rng.standard_normal((max(self.bits, dim), dim))
            if self.bits <= dim:
                drawn = np.linalg.qr(drawn.T)[0].T
            out.append(drawn[:self.bits])
        return np.stack(out)


def _products(signature: Signature, column):
    """(rows, tables, bits) products of an Arrow list column with the planes; all vectors have one length."""
    import numpy as np

    rows = len(column)
    matrix = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(rows, -1)
    planes = signature.planes(matrix.shape[1])
    return np.einsum("nd,tbd->ntb", matrix, planes, optimize=True)


def build_index(vectors: DataFrame, signature: Signature = Signature()) -> DataFrame:
    """(id, tbl, bucket), one row for each vector and table; null vectors are not indexed.

    Written once: several searches may read it. ``vectors`` is (id, vector).
    """
    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                signs = _products(signature, batch.column("vector")) > 0
                buckets = (signs << np.arange(signature.bits)).sum(axis=2)
                at = np.repeat(np.arange(batch.num_rows), signature.tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)),
                     pa.array(np.tile(np.arange(signature.tables), batch.num_rows), pa.int32()),
                     pa.array(buckets.ravel(), pa.int32())], ["id", "tbl", "bucket"])

    held = vectors.filter(F.col("vector").isNotNull()).select("id", "vector")
    return durable(held.mapInArrow(cut, f"id {held.schema['id'].dataType.simpleString()}, tbl int, bucket int"))


def probes(queries: DataFrame, signature: Signature = Signature()) -> DataFrame:
    """(q_id, tbl, bucket) of every bucket a query visits, by the squared products of the signs flipped."""
    def visit(batches):
        import numpy as np
        import pyarrow as pa

        masks = np.arange(1 << signature.bits)
        flips = (masks[:, None] >> np.arange(signature.bits)) & 1
        per_query = signature.tables * min(signature.probes, len(masks))
        for batch in batches:
            for row in range(batch.num_rows):
                product = _products(signature, batch.column("vector").slice(row, 1))[0]
                own = ((product > 0) << np.arange(signature.bits)).sum(axis=1)
                cheapest = np.argsort(product ** 2 @ flips.T, axis=1, kind="stable")[:, :signature.probes]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("q_id").take(pa.array(np.full(per_query, row))),
                     pa.array(np.repeat(np.arange(signature.tables), per_query // signature.tables), pa.int32()),
                     pa.array((own[:, None] ^ cheapest).ravel(), pa.int32())], ["q_id", "tbl", "bucket"])

    asked = queries.filter(F.col("vector").isNotNull()).select("q_id", "vector")
    return asked.mapInArrow(visit, f"q_id {asked.schema['q_id'].dataType.simpleString()}, tbl int, bucket int")


def candidates(index: DataFrame, visited: DataFrame, signature: Signature = Signature()) -> DataFrame:
    """(q_id, id, votes) of the rows a query meets in enough tables.

    A bucket that holds more than its share of the index is split by the row's id, and
    its probes are copied to every part: fewer than 8 buckets for each reduce task can
    be that large, which is what is broadcast.
    """
    sizes = index.groupBy("tbl", "bucket").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    limit = max(-(-total // (8 * shuffle_width(index.sparkSession))), 1)
    large = F.broadcast(sizes.filter(F.col("n") > limit).select("tbl", "bucket", F.ceil(F.col("n") / limit).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    held = index.join(large, ["tbl", "bucket"], "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("parts")
    asked = visited.join(large, ["tbl", "bucket"], "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    met = held.join(asked, ["tbl", "bucket", "part"])
    return met.groupBy("q_id", "id").agg(F.count(F.lit(1)).alias("votes")).filter(F.col("votes") >= signature.votes)


def score(found: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(q_id, id, score) of the candidates: cosine with the query, rounded to 6 places; vectors have unit length."""
    types = {"q_id": queries.schema["q_id"].dataType.simpleString(), "id": vectors.schema["id"].dataType.simpleString()}

    def cosine(batches):
        import numpy as np
        import pyarrow as pa

        matrix = lambda column, n: column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(n, -1)
        for batch in batches:
            if batch.num_rows:
                asked, held = (matrix(batch.column(c), batch.num_rows) for c in ("_q", "vector"))
                norms = np.linalg.norm(asked, axis=1)
                scores = np.einsum("nd,nd->n", asked, held) / np.where(norms == 0, 1.0, norms)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("q_id"), batch.column("id"), pa.array(np.round(scores, 6))], ["q_id", "id", "score"])

    salted = found.select("q_id", "id").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    copies = queries.select("q_id", F.col("vector").alias("_q")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paired = salted.join(vectors.select("id", "vector"), "id").join(copies, ["q_id", "_salt"])
    return paired.select("q_id", "id", "_q", "vector").mapInArrow(
        cosine, f"q_id {types['q_id']}, id {types['id']}, score double")


def best_hits(scored: DataFrame, k: int) -> DataFrame:
    """The k best rows of a query, ranked by score, then id; parts of a query are cut to k rows first."""
    order = [F.desc("score"), F.col("id")]
    part = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    short = scored.withColumn("_part", part).withColumn(
        "_r", F.row_number().over(Window.partitionBy("q_id", "_part").orderBy(*order))).filter(F.col("_r") <= k)
    return short.select("q_id", "id", "score", F.row_number().over(Window.partitionBy("q_id").orderBy(*order)).alias("rank")).filter(
        F.col("rank") <= k)


def index_topk(queries: DataFrame, vectors: DataFrame, k: int = 12, signature: Signature = Signature()) -> tuple[DataFrame, DataFrame]:
    """The k best candidates of each query (q_id, id, score, rank), and the candidates (q_id, id, votes) behind them."""
    found = durable(candidates(build_index(vectors, signature), probes(queries, signature), signature))
    return best_hits(score(found, queries, vectors), k), found


def search_report(hits: DataFrame, exact: DataFrame, found: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: exact hits, the share of them found, pairs scored and the share of all pairs that is."""
    pairs = queries.agg(F.count(F.lit(1))).scalar() * vectors.agg(F.count(F.lit(1))).scalar()
    seen = exact.join(hits.select("q_id", "id").withColumn("_hit", F.lit(1)), ["q_id", "id"], "left")
    return seen.agg(F.count(F.lit(1)).alias("hits"), F.round(F.count("_hit") / F.count(F.lit(1)), 4).alias("recall")).select(
        "hits", "recall", found.agg(F.count(F.lit(1))).scalar().alias("scored"),
        F.round(found.agg(F.count(F.lit(1))).scalar() / pairs, 4).alias("scored_share"))
