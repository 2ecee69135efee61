"""Typed knowledge graph: nodes, edges, leak-free splits, negatives, neighbour means."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import dot, hash_long, sigmoid
from netsleuth.operators.ranking import hash_rank, ranks_beyond, spread_lookup
from netsleuth.operators.splits import three_way_split
from netsleuth.session import durable, durable_partitions, shuffle_width

# Bundle object type to node kind.
NODE_KINDS = {
    "attack-pattern": "technique",
    "intrusion-set": "group",
    "malware": "software",
    "tool": "software",
}
# Fixed values: (relationship type, source kind, target kind) to relation name.
RELATIONS = {
    ("uses", "group", "technique"): "group_uses_technique",
    ("uses", "software", "technique"): "software_uses_technique",
    ("uses", "group", "software"): "group_uses_software",
    ("subtechnique-of", "technique", "technique"): "subtechnique_of",
}
TARGET = "group_uses_technique"


def active() -> Column:
    """Neither revoked nor deprecated; an absent flag means neither."""
    return ~F.coalesce("revoked", F.lit(False)) & ~F.coalesce("x_mitre_deprecated", F.lit(False))


def mitre_reference() -> Column:
    """The first external reference of the framework itself, null when none."""
    return F.get(F.filter("external_references", lambda r: r["source_name"] == "mitre-attack"), F.lit(0))


def graph_nodes(objects: DataFrame) -> DataFrame:
    """Active entities as (id, kind, name, ext_id); only techniques carry an ext_id."""
    kinds = F.create_map(*[F.lit(x) for pair in NODE_KINDS.items() for x in pair])
    return objects.filter(F.col("type").isin(list(NODE_KINDS)) & active()).select(
        "id", kinds[F.col("type")].alias("kind"), F.coalesce("name", F.lit("?")).alias("name"),
        F.when(F.col("type") == "attack-pattern", F.coalesce(mitre_reference()["external_id"], F.lit("")))
        .otherwise("").alias("ext_id"))


def dense_index(nodes: DataFrame, by: list[str] = (), out: str = "idx") -> DataFrame:
    """Consecutive index 0..n-1 in a stable order, overall or within ``by``."""
    ranked = hash_rank(nodes, ["id"], 0, by, out="_rank")
    return ranked.select(*nodes.columns, (F.col("_rank") - 1).alias(out))


def graph_edges(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """Active relationships between known nodes, routed to the four relation types.

    The result is cut from its lineage: every graph operator reads it several times. Edges meet the nodes of both ends
    at once, in tiles between blocks of nodes, as hashes that no two nodes share.
    """
    types = sorted({kind for kind, _, _ in RELATIONS})
    asked = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("relationship_type"))
    told = durable(relations.filter(active() & F.col("relationship_type").isin(types)).select(
        F.col("source_ref").alias("src"), F.col("target_ref").alias("dst"), (asked - 1).cast("byte").alias("t")), "zstd")
    ends, seed = _coded(nodes.select("id", "kind"))
    packed, of_block, block, tiles = _tiled(ends, told, seed, ROW_EDGES)
    sent = ends.filter(F.col("code").isNotNull()).withColumn("block", block).join(F.broadcast(of_block), "block").select(
        "tile", "code", "id", "kind").repartition(tiles, "tile")
    return durable(packed.groupBy("tile").cogroup(sent.groupBy("tile")).applyInArrow(
        _typed(types), "src string, dst string, rel string"), "zstd")


def _typed(types: list[str]):
    """Kernel: one tile's packed edges with the nodes of its blocks as rows (src, dst, rel), for every row of a node."""
    names = sorted(set(RELATIONS.values()))
    kinds = sorted({k for _, s, d in RELATIONS for k in (s, d)})

    def run(edges, nodes):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        rel_of = np.full((len(types), len(kinds) + 1, len(kinds) + 1), -1)
        for (t, s, d), name in RELATIONS.items():
            rel_of[types.index(t), kinds.index(s), kinds.index(d)] = names.index(name)
        schema = pa.schema([("src", pa.string()), ("dst", pa.string()), ("rel", pa.string())])
        nodes = nodes.take(pc.sort_indices(nodes, sort_keys=[("code", "ascending")])).combine_chunks()
        codes, starts, many = np.unique(nodes.column("code").to_numpy(), return_index=True, return_counts=True)
        ids = nodes.column("id").cast(pa.string())
        kind = pc.fill_null(pc.index_in(nodes.column("kind"), pa.array(kinds)), len(kinds)).to_numpy()
        out = []
        for i in range(edges.num_rows if len(codes) else 0):
            s, d = (np.frombuffer(edges.column(c)[i].as_buffer(), dtype=np.int64) for c in ("s", "d"))
            t = np.frombuffer(edges.column("t")[i].as_buffer(), dtype=np.int8)
            at, to = (np.minimum(np.searchsorted(codes, x), len(codes) - 1) for x in (s, d))
            known = (codes[at] == s) & (codes[to] == d)
            at, to, t = at[known], to[known], t[known]
            # a node that comes as several rows gives an edge each
            times = many[at] * many[to]
            turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            width = np.repeat(many[to], times)
            source = np.repeat(starts[at], times) + turn // width
            target = np.repeat(starts[to], times) + turn % width
            rel = rel_of[np.repeat(t, times), kind[source], kind[target]]
            kept = rel >= 0
            out.append(pa.RecordBatch.from_arrays(
                [ids.take(pa.array(source[kept])).combine_chunks(), ids.take(pa.array(target[kept])).combine_chunks(),
                 pa.array(names).take(pa.array(rel[kept]))], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    return nodes.groupBy(F.col("kind").alias("what")).agg(count).unionByName(
        edges.groupBy(F.col("rel").alias("what")).agg(count))


def undirected(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, in one pass over the input."""
    there = F.struct(F.col("src").alias("src"), F.col("dst").alias("dst"))
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select(F.inline(F.array(there, back)))


def target_split(edges: DataFrame, val_frac: float = 0.1, test_frac: float = 0.1, seed: int = 42) -> DataFrame:
    """Target edges with their part: train, val or test."""
    target = edges.filter(F.col("rel") == TARGET).select("src", "dst")
    return durable(three_way_split(target, ["src", "dst"], val_frac, test_frac, seed))


def message_edges(edges: DataFrame, split: DataFrame) -> DataFrame:
    """Undirected graph of auxiliary and train target edges; val and test never enter."""
    return undirected(message_once(edges, split))


def message_once(edges: DataFrame, split: DataFrame) -> DataFrame:
    """The edges of :func:`message_edges`, each in one direction."""
    train = split.filter(F.col("part") == "train").select("src", "dst")
    return edges.filter(F.col("rel") != TARGET).select("src", "dst").unionByName(train)


def leaked_edges(message: DataFrame, split: DataFrame) -> DataFrame:
    """Held-out target edges found in the message graph; should be empty."""
    held = split.filter(F.col("part") != "train").select("src", "dst")
    return held.join(message, ["src", "dst"], "left_semi")


ROUNDS = 4


def permuted(i: Column, half: int, seed) -> Column:
    """A keyed permutation of the numbers below 2^(2 * half): each round mixes a hash of one half into the other."""
    mask = (1 << half) - 1
    left, right = F.shiftright(i, half), i.bitwiseAND(F.lit(mask))
    for turn in range(ROUNDS):
        left, right = right, left.bitwiseXOR(hash_long(f"{seed}.{turn}", right).bitwiseAND(F.lit(mask)))
    return F.shiftleft(left, half).bitwiseOR(right)


def sample_negatives(nodes: DataFrame, edges: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """min(n, available) distinct (group, technique) pairs that are no edge, drawn at random by the seed.

    A keyed permutation puts the group x technique cells into an order like a shuffled
    one: it permutes the next even number of bits, and numbers outside the grid are
    stepped over. The first n cells that are no edge are the sample. Steps are generated
    in place, as many as the density of edges calls for and more only if they fall short.
    """
    spark = nodes.sparkSession
    known = edges.select("src", "dst")
    sizes = {r["kind"]: r["n"] for r in nodes.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups, techniques = sizes.get("group", 0), sizes.get("technique", 0)
    cells = groups * techniques
    if min(cells, n) == 0:
        return known.limit(0)
    half = max(1, -(-(cells - 1).bit_length() // 2))
    numbers = 1 << (2 * half)
    indexed = durable(dense_index(nodes.select("id", "kind"), by=["kind"]))
    pick = lambda kind, key, name: indexed.filter(F.col("kind") == kind).select(
        F.col("idx").alias(key), F.col("id").alias(name))
    # an estimate is enough: the steps taken change the speed alone
    held = known.agg(F.approx_count_distinct(F.xxhash64("src", "dst"))).first()[0]
    free_cells = max(cells - held, 1)
    steps = min(numbers, int(1.1 * n * numbers / free_cells) + 256)
    while True:
        # one shuffled projection a round: the halves are hashed once each
        walk = spark.range(steps).select(F.col("id").alias("step"), permuted(F.col("id"), half, seed).alias("_c")).filter(
            F.col("_c") < cells).selectExpr("step", f"_c div {techniques} as _g", f"_c % {techniques} as _t")
        pairs = walk.join(pick("group", "_g", "src"), "_g").join(pick("technique", "_t", "dst"), "_t")
        free = durable(pairs.join(known, ["src", "dst"], "left_anti").select("step", "src", "dst"))
        if steps == numbers or free.count() >= n:
            break
        steps = min(numbers, 2 * steps)
    width = max(1, steps // (16 * shuffle_width(spark)))
    drawn = ranks_beyond(free, F.expr(f"step div {width}"), [F.col("step")], [F.lit(n)])
    return durable(drawn.filter(F.col("beyond") == 0).select("src", "dst"))


#: Nodes of a block and edges of a tile, which is what a task of a hop holds; edges of a tile whose rows leave it.
BLOCK_NODES, TILE_EDGES, ROW_EDGES = 2_000_000, 16_000_000, 4_000_000
#: Edges that are packed or summed at once.
CHUNK_EDGES = 2_000_000


def _coded(nodes: DataFrame) -> tuple[DataFrame, int]:
    """``nodes`` with ``code``, a 64-bit hash of the id that no other id of theirs has, and the seed that gives it."""
    seed = 0
    while True:
        coded = nodes.withColumn("code", _code("id", seed))
        clash = coded.groupBy("code").agg((F.min("id") != F.max("id")).alias("_c")).agg(F.max("_c")).first()[0]
        if not clash:
            return coded, seed
        seed += 1


def _code(key: str, seed: int) -> Column:
    return F.when(F.col(key).isNotNull(), F.xxhash64(F.lit(seed), F.col(key).cast("string")))


def _tiled(nodes: DataFrame, told: DataFrame, seed: int, most: int) -> tuple[DataFrame, DataFrame, Column, int]:
    """Packed edges (tile, s, d, t) by tile, the tiles of each block (block, tile), a node's block, and the number of partitions.

    What meets the edges is dealt out into as many partitions: with another number Spark would shuffle the edges once more. Nodes fall into blocks and edges into tiles by the blocks of their ends, whichever way they point. A tile with more
    than ``most`` edges is dealt out, so that a hub is too.
    """
    coded = told.select(_code("src", seed).alias("s"), _code("dst", seed).alias("d"), "t").filter("s is not null and d is not null")
    n_edges, n_nodes = coded.count(), nodes.count()
    spark = nodes.sparkSession
    context = spark.sparkContext
    tasks = max(n_edges / most, min(context.defaultParallelism, n_edges / CHUNK_EDGES))
    n = max(1, -(-n_nodes // BLOCK_NODES), math.ceil(math.sqrt(2 * tasks)))
    block = lambda c: F.pmod(F.shiftright(F.col(c), 8), F.lit(n))
    met = coded.withColumn("_t", F.least(block("s"), block("d")) * n + F.greatest(block("s"), block("d")))
    sizes = {r["_t"]: r["count"] for r in met.groupBy("_t").count().collect()}
    first, of_block = [], []
    for t in sorted(sizes):
        parts, low = -(-sizes[t] // most), first[-1][1] + first[-1][2] if first else 0
        first.append((t, low, parts))
        of_block += [(k, low + i) for k in {t // n, t % n} for i in range(parts)]
    placed = met.join(F.broadcast(spark.createDataFrame(first, "_t long, _low int, _parts int")), "_t").select(
        (F.col("_low") + F.pmod(F.xxhash64("s", "d"), F.col("_parts"))).cast("int").alias("tile"), "s", "d", "t")

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        def out(waiting):
            tile, s, d, t = (np.concatenate(x) for x in zip(*waiting))
            # by source too: repeats lie side by side, which packs and looks up better
            order = np.lexsort((s, tile))
            tiles, starts = np.unique(tile[order], return_index=True)
            cut = lambda x: [p.tobytes() for p in np.split(x[order], starts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(tiles, pa.int32()), *[pa.array(cut(x), pa.binary()) for x in (s, d, t)]],
                                              ["tile", "s", "d", "t"])

        waiting, held = [], 0
        for batch in batches:
            waiting.append([batch.column(c).to_numpy() for c in ("tile", "s", "d", "t")])
            held += batch.num_rows
            if held >= CHUNK_EDGES:
                yield out(waiting)
                waiting, held = [], 0
        if held:
            yield out(waiting)

    tiles = max(1, len({t for _, t in of_block}))
    packed = placed.mapInArrow(pack, "tile int, s binary, d binary, t binary").repartition(tiles, "tile")
    return packed, spark.createDataFrame(of_block, "block long, tile int"), block("code"), tiles


def _tile_sums(columns: list[str], mirrored: bool):
    """Kernel of a hop: for one tile's packed edges and the nodes of its blocks, what each target receives there."""

    def run(edges, nodes):
        import numpy as np
        import pyarrow as pa

        order = np.argsort(nodes.column("code").to_numpy(), kind="stable")
        codes, starts = np.unique(nodes.column("code").to_numpy()[order], return_index=True)
        own = []
        if len(codes):
            for c in columns:
                cell = nodes.column(c)
                own.append(np.add.reduceat(cell.fill_null(0.0).to_numpy()[order], starts))
                own.append(np.add.reduceat(cell.is_valid().to_numpy().astype("float64")[order], starts))
        got = np.zeros((2 * len(columns), len(codes)))
        waiting, held = [], 0

        def send(s, d):
            at, to = (np.minimum(np.searchsorted(codes, x), len(codes) - 1) for x in (s, d))
            known = (codes[at] == s) & (codes[to] == d)
            at, to = at[known], to[known]
            for source, target in [(at, to), (to, at)][:2 if mirrored else 1]:
                for i, values in enumerate(own):
                    got[i] += np.bincount(target, values[source], len(codes))

        for i in range(edges.num_rows if len(codes) else 0):
            waiting.append([np.frombuffer(edges.column(c)[i].as_buffer(), dtype=np.int64) for c in ("s", "d")])
            held += len(waiting[-1][0])
            if held >= 2 * CHUNK_EDGES or i + 1 == edges.num_rows:
                send(*(np.concatenate(x) for x in zip(*waiting)))
                waiting, held = [], 0
        reached = got[1::2].any(axis=0)
        return pa.table({"code": codes[reached].astype("int64"), **{f"_{'sn'[i % 2]}_{columns[i // 2]}": got[i][reached] for i in range(len(got))}})

    return run


def neighbour_mean(features: DataFrame, message: DataFrame, columns: list[str], hops: int = 2,
                   mirrored: bool = False) -> DataFrame:
    """Average each node with the mean of its neighbours, hop by hop.

    ``features`` has one row per node id and numeric feature columns. A node without neighbours keeps its values.
    ``message`` sends from src to dst; if ``mirrored``, each of its rows sends both ways. Edges are dealt out once, in tiles
    between blocks of nodes, and stay where they lie: a hop sends a node's values once to each tile of its block, and the
    sums of a tile back, not a row for each edge. Each hop ends in a table.
    """
    state, seed = _coded(durable(features.select("id", *columns)))
    edges, of_block, block, parts = _tiled(state, message.withColumn("t", F.lit(0).cast("byte")), seed, TILE_EDGES)
    edges = durable_partitions(edges.drop("t"))
    shape = ", ".join(f"_s_{c} double, _n_{c} double" for c in columns)
    for hop in range(hops):
        sent = state.filter(F.col("code").isNotNull()).withColumn("block", block).join(F.broadcast(of_block), "block").select(
            "tile", "code", *[F.col(c).cast("double").alias(c) for c in columns]).repartition(parts, "tile")
        tiles = edges.groupBy("tile").cogroup(sent.groupBy("tile")).applyInArrow(
            _tile_sums(columns, mirrored), f"code long, {shape}")
        means = tiles.groupBy(F.col("code").alias("_code")).agg(
            *[(F.sum("_s_" + c) / F.nullif(F.sum("_n_" + c), F.lit(0.0))).alias("_m_" + c) for c in columns])
        state = state.join(means, F.col("code") == F.col("_code"), "left").select(
            "id", "code", *[((F.col(c) + F.coalesce("_m_" + c, c)) / 2.0).alias(c) for c in columns])
        state = durable(state)
    return state.select("id", *columns)


def pair_score(z: DataFrame, pairs: DataFrame, vector: str = "z") -> DataFrame:
    """Sigmoid of the inner product for every (src, dst) pair."""
    side = lambda key, name: z.select(F.col("id").alias(key), F.col(vector).alias(name))
    both = spread_lookup(pairs, side("src", "_zs"), "src", ["_zs"])
    both = spread_lookup(both, side("dst", "_zd"), "dst", ["_zd"], sketch=pairs)
    return both.withColumn("score", sigmoid(dot(F.col("_zs"), F.col("_zd")))).drop("_zs", "_zd")
