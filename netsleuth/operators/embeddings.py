"""Dense vectors: centroids and exact or probed nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_QUERIES = 4096
BLOCK_ROWS = 100_000


def centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label, rounded to 6 places; averages are combined map-side per dimension."""
    parts = vectors.select(label, F.posexplode(vector).alias("_i", "_v")).groupBy(label, "_i").agg(
        F.round(F.avg(F.col("_v").cast("double")), 6).alias("_m"))
    # one entry per dimension, so the collected group is as long as a vector
    return parts.groupBy(label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias("centroid"))


def _best_of_block():
    """Kernel: the k best rows of a block for every query, by (rounded cosine, id).

    Shipped to the tasks by value; a block of identical vectors still yields k rows.
    """

    def best(q_ids, q_matrix, v_ids, v_matrix, k):
        import numpy as np

        scores = np.round(v_matrix.astype("float64") @ q_matrix.T, 6)
        for j, q_id in enumerate(q_ids):
            column = scores[:, j]
            rows = np.arange(len(column))
            if len(rows) > k:
                bar = np.partition(column[rows], len(rows) - k)[len(rows) - k]
                rows = rows[column[rows] >= bar]
            order = np.lexsort((v_ids[rows], -column[rows]))[:k]
            for r in rows[order]:
                yield q_id, v_ids[r], float(column[r])

    return best


def _rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """Global top k from the per-block survivors."""
    order = Window.partitionBy("q_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def vector_topk(queries: DataFrame, vectors: DataFrame, k: int = 12) -> DataFrame:
    """The k nearest vectors of each query by cosine: (q_id, id, score, rank).

    ``queries`` is (q_id, vector), ``vectors`` (id, vector) of unit length. Up to
    4,096 queries go to the tasks as one matrix and the vectors are scanned where
    they lie; each block keeps k rows per query. More queries meet the vectors block
    by block instead. ``signature_index`` is the search that leaves most vectors unscored.
    """
    spark = vectors.sparkSession
    best = _best_of_block()
    id_type = vectors.schema["id"].dataType.simpleString()
    q_type = queries.schema["q_id"].dataType.simpleString()
    out = f"q_id {q_type}, id {id_type}, score double"

    def unit(matrix):
        import numpy as np

        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(norms == 0, 1.0, norms)

    # at most one row above the bound reaches the driver
    head = queries.select("q_id", "vector").limit(MAX_QUERIES + 1).collect()
    if len(head) <= MAX_QUERIES:
        if not head:
            return vectors.select(F.lit(None).cast(q_type).alias("q_id"), "id", F.lit(0.0).alias("score"),
                                  F.lit(0).alias("rank")).limit(0)
        import numpy as np
        from pyspark.sql.pandas.types import to_arrow_type

        q_arrow = to_arrow_type(queries.schema["q_id"].dataType)
        shipped = spark.sparkContext.broadcast(
            ([r["q_id"] for r in head], unit(np.array([r["vector"] for r in head], dtype="float64"))))

        def scan(batches):
            import pyarrow as pa

            q_ids, q_matrix = shipped.value
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
                v_matrix = flat.reshape(batch.num_rows, -1)
                v_ids = batch.column("id").to_numpy(zero_copy_only=False)
                found = list(best(q_ids, q_matrix, v_ids, v_matrix, k))
                if found:
                    q, v, s = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q).cast(q_arrow), pa.array(v).cast(batch.column("id").type), pa.array(s)],
                        names=["q_id", "id", "score"])

        hits = vectors.select("id", "vector").mapInArrow(scan, out)
        return _rank_hits(hits, k)

    q_blocks = -(-queries.count() // MAX_QUERIES)
    v_blocks = -(-vectors.count() // BLOCK_ROWS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("q_id", "vector", F.pmod(F.xxhash64("q_id"), F.lit(q_blocks)).cast("int").alias("qb"),
                           every(v_blocks).alias("vb"))
    held = vectors.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(v_blocks)).cast("int").alias("vb"),
                          every(q_blocks).alias("qb"))

    def meet(q_pdf, v_pdf):
        import numpy as np
        import pandas as pd

        if len(q_pdf) == 0 or len(v_pdf) == 0:
            return pd.DataFrame({"q_id": [], "id": [], "score": []})
        q_matrix = unit(np.array(q_pdf["vector"].tolist(), dtype="float64"))
        v_matrix = np.array(v_pdf["vector"].tolist())
        found = best(q_pdf["q_id"].to_numpy(), q_matrix, v_pdf["id"].to_numpy(), v_matrix, k)
        return pd.DataFrame(found, columns=["q_id", "id", "score"])

    hits = asked.groupBy("qb", "vb").cogroup(held.groupBy("qb", "vb")).applyInPandas(meet, out)
    return _rank_hits(hits, k)
