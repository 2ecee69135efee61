"""Embedding near-dedup: spherical k-means cells, cosine products in blocks, one representative per group.

Centroids are fitted on at most ``SAMPLE`` vectors, in hash order of vec_id. Every
vector lives in the cell of its nearest centroid and visits each cell whose bisecting
plane is within half the chord of the threshold: of two vectors that close, one at
least is that near to the plane between their cells, so the search loses no link.
Equal vectors collapse to one weighted row first. A cell is dealt out as pairs of
blocks of at most ``BLOCK`` rows, so a cell that holds most rows is many small tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import components, ship, written

SAMPLE = 20_000
CELL_ROWS = 2000
MOST_CELLS = 1024
BLOCK = 2048
#: Wider than the error of a cosine of unit vectors in single precision.
MARGIN = 2e-5


def fit_centroids(x, cells: int, rounds: int = 12):
    """Unit centroids by spherical k-means from spread-out seeds; deterministic."""
    import numpy as np

    rng = np.random.default_rng(3)
    centroids = x[rng.choice(len(x), size=min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centroids.T, axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        norms = np.linalg.norm(total, axis=1)
        kept = norms > 1e-12
        centroids[kept] = total[kept] / norms[kept, None]
    # equal centroids have no plane between them
    return np.unique(np.round(centroids, 12), axis=0)


def _unit(column):
    """Float64 rows of an Arrow list column scaled to length one."""
    import numpy as np

    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assign(centroids, reach):
    """Kernel: home cell of every vector and the cells it visits."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        gaps = np.linalg.norm(centroids[:, None, :] - centroids[None, :, :], axis=2) if len(centroids) <= 256 else None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("vec"))
            dots = x @ centroids.T
            home = np.argmax(dots, axis=1)
            own = dots[np.arange(len(x)), home]
            visits = []
            for a in range(0, len(x), 256):
                h = home[a:a + 256]
                gap = gaps[h] if gaps is not None else np.sqrt(np.maximum(2 - 2 * centroids[h] @ centroids.T, 0))
                # distance to the plane between two cells: (|x - c|^2 - |x - home|^2) / (2 |c - home|)
                near = own[a:a + 256, None] - dots[a:a + 256] <= (reach + 1e-9) * gap
                near[np.arange(len(h)), h] = False
                visits.extend(np.flatnonzero(row).astype(np.int32) for row in near)
            ends = np.concatenate([[0], np.cumsum([len(v) for v in visits])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("weight"), batch.column("vec"), pa.array(home.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(visits).astype(np.int32)))],
                names=["id", "weight", "vec", "home", "visits"])

    return run


def _compare(threshold):
    """Kernel over a pair of blocks: (id, other, n) with n links of id, and breadth-first links to other."""

    def run(group):
        import numpy as np
        import pyarrow as pa

        cell = group.column("cell")[0].as_py()
        side = group.column("side").to_numpy()
        home = group.column("home").to_numpy()
        ids, weight = group.column("id").to_numpy(), group.column("weight").to_numpy()
        x = _unit(group.column("vec").combine_chunks())
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        # single precision decides all but the pairs next to the threshold, double precision those
        single = x.astype(np.float32)
        cosine = single[left] @ single[right].T
        links = cosine >= threshold + MARGIN
        i, j = np.nonzero((cosine >= threshold - MARGIN) & ~links)
        for a in range(0, len(i), 65_536):
            part = slice(a, a + 65_536)
            links[i[part], j[part]] = np.einsum("nd,nd->n", x[left[i[part]]], x[right[j[part]]]) >= threshold
        del cosine
        # a pair that meets in both of its cells counts in the smaller one
        seen = np.zeros((len(left), int(home.max()) + 1), dtype=bool)
        for at, cells in enumerate(group.column("visits").take(left).to_pylist()):
            seen[at, [c for c in cells if c < seen.shape[1]]] = True
        i, j = np.nonzero(links)
        theirs = home[right[j]]
        drop = (left[i] == right[j]) | ((theirs < cell) & seen[i, theirs])
        links[i[drop], j[drop]] = False
        i, j = i[~drop], j[~drop]
        whole = bool((side == 2).any())
        n = np.bincount(left[i], weights=weight[right[j]], minlength=len(ids)).astype(np.int64)
        if not whole:
            n += np.bincount(right[j], weights=weight[left[i]], minlength=len(ids)).astype(np.int64)
        rows = [(ids[i], None, int(n[i])) for i in np.flatnonzero(n)]
        # spanning links of the block pair
        at_left, at_right = np.full(len(ids), -1), np.full(len(ids), -1)
        at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
        free = np.ones(len(ids), dtype=bool)
        for seed in np.flatnonzero(n):
            if not free[seed]:
                continue
            free[seed], queue = False, [seed]
            while queue:
                i = queue.pop()
                near = np.zeros(len(ids), dtype=bool)
                if at_left[i] >= 0:
                    near[right[links[at_left[i]]]] = True
                if at_right[i] >= 0:
                    near[left[links[:, at_right[i]]]] = True
                new = np.flatnonzero(near & free)
                free[new] = False
                rows.extend((ids[i], ids[j], 0) for j in new)
                queue.extend(new.tolist())
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["id", "other", "n"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding",
                 cells: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors link at a cosine of ``threshold`` or more, computed in double precision;
    ``component_id`` is the smallest id reachable over links. Vectors that are null, empty
    or zero, or hold a null or non-finite component, link with nothing, and vectors of
    different lengths do not link. Repeated rows of one id count as one vector and give
    a row each. Rows without id are left out; other columns are ignored.
    """
    import numpy as np

    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec")).filter(
        F.col("vec_id").isNotNull())
    usable = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v)) & F.exists("vec", lambda v: v != 0)
    named = rows.withColumn("cls", F.when(F.coalesce(usable, F.lit(False)), F.sha2(F.array_join("vec", ","), 256)))
    classes = written(named.filter("cls is not null").groupBy("cls").agg(
        F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("weight"), F.first("vec").alias("vec")), "vectors")
    linked = []
    # one round per vector length; a table has few
    for (length, count) in classes.groupBy(F.size("vec")).count().orderBy(F.size("vec")).collect():
        same = classes.filter(F.size("vec") == length).select("id", "weight", "vec")
        wanted = cells or max(1, min(MOST_CELLS, -(-count // CELL_ROWS)))
        sample = same.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()
        centroids = fit_centroids(_unit(sample.column("vec").combine_chunks()), wanted)
        reach = float(np.sqrt(2 - 2 * threshold) / 2)
        homes = written(same.mapInArrow(
            _assign(centroids, reach), "id long, weight long, vec array<double>, home int, visits array<int>"), "cells")
        placed = homes.select("*", F.explode(F.concat(F.array("home"), "visits")).alias("cell")).withColumn("guest", F.col("home") != F.col("cell"))
        sizes = placed.groupBy("cell").agg(F.count_if(~F.col("guest")).alias("_h"), F.count_if("guest").alias("_g"))
        # one row per cell, MOST_CELLS at most
        placed = placed.join(F.broadcast(sizes), "cell").withColumns({
            "_hb": F.ceil(F.col("_h") / BLOCK).cast("int"), "_gb": F.ceil(F.col("_g") / BLOCK).cast("int")})
        block = F.pmod(F.xxhash64("id"), F.when(F.col("guest"), F.col("_gb")).otherwise(F.col("_hb"))).cast("int")
        placed = placed.withColumn("_b", block)
        pair = lambda i, j, kind, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(kind).alias("kind"), F.lit(side).alias("side"))
        every = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        # home blocks meet each other once, and every block of guests
        own = F.transform(every(F.col("_hb")), lambda o: F.when(o == F.col("_b"), pair(o, o, 0, 2)).when(
            o < F.col("_b"), pair(o, F.col("_b"), 0, 1)).otherwise(pair(F.col("_b"), o, 0, 0)))
        hosts = F.transform(every(F.col("_gb")), lambda o: pair(F.col("_b"), o, 1, 0))
        comes = F.transform(every(F.col("_hb")), lambda o: pair(o, F.col("_b"), 1, 1))
        dealt = placed.select("cell", "id", "weight", "vec", "home", "visits", F.explode(
            F.when(F.col("guest"), comes).otherwise(F.concat(own, hosts))).alias("_p")).select("*", "_p.i", "_p.j", "_p.kind", "_p.side").drop("_p")
        linked.append(dealt.groupBy("cell", "i", "j", "kind").applyInArrow(_compare(threshold), "id long, other long, n long"))
    if not linked:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = linked[0]
    for more in linked[1:]:
        found = found.unionByName(more)
    found = written(found, "links")
    counts = found.filter("other is null").groupBy("id").agg(F.sum("n").alias("_n"))
    groups = components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    per_class = classes.select("cls", "id", "weight").join(counts, "id", "left").join(groups, "id", "left").select(
        "cls", (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = named.select("vec_id", "cls").join(written(per_class, "classes"), "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (F.col("vec_id") == component).alias("kept"))


def brute_force_links(vectors: DataFrame, asked: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links) of the ``asked`` rows of usable vectors against all, to measure recall.

    The asked matrix, a stated set of queries, is sent to every task; the vectors are scanned in place.
    """
    import numpy as np

    spark = vectors.sparkSession
    ship(spark)
    table = asked.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")).toArrow()
    queries = spark.sparkContext.broadcast((table.column("vec_id").to_numpy(), _unit(table.column("vec").combine_chunks())))

    def run(batches):
        import pyarrow as pa

        ids, q = queries.value
        for batch in batches:
            if batch.num_rows:
                own = batch.column("vec_id").to_numpy()
                links = (q @ _unit(batch.column("vec")).T >= threshold) & (ids[:, None] != own[None, :])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.sum(axis=1).astype(np.int64))], names=["vec_id", "n"])

    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    return rows.mapInArrow(run, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n_links"))
