"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

Every document becomes the sorted array of its distinct word shingles. A shingle id
holds its length class in the top byte (longer first) and 56 bits of its hash below.
The shingles of ``SAMPLE`` documents are counted; those that several of them hold come
last, by their count, all others first, by id. Two sets that reach the similarity share
a shingle among the first ``n - ceil(t n) + 1`` in that order; a tile holds the
documents that share one such shingle, ordered by set size.

1. Equal sets collapse into one class (a 64-bit set hash; classes are then one row).
2. Inside a tile only sizes within the band meet. The bit counts of the parity bitmaps
   bound the overlap from above; surviving pairs are walked breadth first, so a tile of
   m members gives fewer than m links, never all pairs. A bitmap has four bits for each
   element by which two sets of that size may differ, 512 at least, so unrelated sets of any
   size differ in twice the bits allowed; of two widths the wider is folded to the other.
3. The linked classes form groups. Each member's text is shuffled to two size bands of
   its group, where wider bitmaps bound the pairs again and the sorted arrays are intersected.

A tile or size band beyond one block is dealt out (``_spanning``): first each block is walked by itself, then one row
of each set linked so far, then pairs of blocks for what is still apart, so a task holds two blocks at most.

No shingle, document or pair is capped: an order of shingles changes the speed alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import components, texts, written

SMALL_GROUP = 48
TILE_BITS = 512
#: 64-bit words compared in one go.
COMPARED = 1 << 18
#: Documents whose shingles are counted, and in how many of them a shingle is common.
SAMPLE = 10_000
COMMON = 4
#: Rows of a block of a tile.
TILE_BLOCK = 4096
#: Shingles of a block of a group; a row counts ROW_MASS more.
GROUP_BLOCK = 1 << 21
ROW_MASS = 512
#: Dealt units that may be broadcast.
MOST_SENT = 100_000


def _shingles(words, row, width):
    """Sorted distinct shingle ids of one text of a Words chunk."""
    import numpy as np

    from netsleuth.llm.words import windows

    a, b = words.first[row], words.first[row + 1]
    if a == b:
        return np.zeros(0, dtype=np.uint64)
    width = min(width, b - a)
    total = np.concatenate([[0], np.cumsum(words.length[a:b])])
    size = np.minimum(total[width:] - total[:-width], 255).astype(np.uint64)
    ids = ((np.uint64(255) - size) << np.uint64(56)) | (windows(words.hash[a:b], width) >> np.uint64(8))
    return np.unique(ids)


def _bitmap(ids, bits):
    """Parity bitmap as 64-bit words: one bit flips for each element of a symmetric difference."""
    import numpy as np

    odd = np.bincount((ids & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _bits_for(n, num, den):
    """Bits of the bitmap of a set of ``n``: four times the largest difference from a set as large."""
    most = -(-2 * n * (den - num) // (den + num))
    return max(TILE_BITS, 1 << int(4 * most - 1).bit_length()) if most else TILE_BITS


class _Bitmaps:
    """Bitmaps of several widths: a row is kept at its own and folded to every smaller width in use."""

    def __init__(self, packed):
        import numpy as np

        self.width = np.array([len(p) // 8 for p in packed], dtype=np.int64)
        self.place, self.rows = {}, {}
        wider, held = None, np.zeros(0, dtype=np.int64)
        for w in np.unique(self.width)[::-1].tolist():
            own = np.flatnonzero(self.width == w)
            matrix = np.frombuffer(b"".join([packed[i] for i in own]), dtype=np.uint64).reshape(len(own), w)
            if wider is not None:
                folded = np.bitwise_xor.reduce(wider.reshape(len(wider), -1, w), axis=1)
                matrix = np.concatenate([folded, matrix])
            held = np.concatenate([held, own])
            place = np.full(len(packed), -1, dtype=np.int64)
            place[held] = np.arange(len(held))
            self.place[w], self.rows[w], wider = place, matrix, matrix

    def apart(self, i, j):
        """In how many bits the rows ``i`` differ from the rows ``j``; ``i`` may be one row."""
        import numpy as np

        j = np.asarray(j)
        i = np.broadcast_to(i, j.shape)
        common = np.minimum(self.width[i], self.width[j])
        out = np.zeros(len(j), dtype=np.int64)
        for w in np.unique(common).tolist():
            rows, place, which = self.rows[w], self.place[w], np.flatnonzero(common == w)
            for some in np.array_split(which, max(1, len(which) * w // COMPARED)):
                differ = rows[place[i[some]]] ^ rows[place[j[some]]]
                out[some] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        return out


def _near(bitmaps, sizes, i, others, num, den):
    """Those of ``others`` whose size and bit counts still allow the similarity with ``i``."""
    import numpy as np

    lo, hi = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
    others = others[den * lo >= num * hi]
    return others[(den + num) * bitmaps.apart(i, others) <= (den - num) * (sizes[others] + sizes[i])]


def _walk(bitmaps, sizes, num, den, check=None):
    """Breadth-first links (i, j) of a group ordered by size: one fewer than each component's members."""
    import numpy as np

    found, free = [], np.ones(len(sizes), dtype=bool)
    for seed in range(len(sizes)):
        if not free[seed]:
            continue
        free[seed] = False
        queue = [seed]
        while queue:
            i = queue.pop()
            # only the band of sizes that can reach the similarity
            a = np.searchsorted(sizes, -(-num * sizes[i] // den), side="left")
            b = np.searchsorted(sizes, den * sizes[i] // num, side="right")
            others = _near(bitmaps, sizes, i, a + np.flatnonzero(free[a:b]), num, den)
            if check is not None:
                others = np.array([j for j in others if check(i, j)], dtype=np.int64)
            free[others] = False
            found.extend((i, int(j)) for j in others)
            queue.extend(others.tolist())
    return found


def _across(bitmaps, sizes, side, comp, num, den, check=None):
    """Links (i, j) from rows of side 0 to rows of side 1, both ordered by size, that join different ``comp``."""
    import numpy as np

    found, comp = [], np.unique(comp, return_inverse=True)[1]
    right = np.flatnonzero(side == 1)
    ordered = sizes[right]
    for i in np.flatnonzero(side == 0):
        a = np.searchsorted(ordered, -(-num * sizes[i] // den), side="left")
        b = np.searchsorted(ordered, den * sizes[i] // num, side="right")
        others = right[a:b]
        for j in _near(bitmaps, sizes, i, others[comp[others] != comp[i]], num, den):
            if comp[j] != comp[i] and (check is None or check(i, j)):
                found.append((i, j))
                comp[comp == comp[j]] = comp[i]
    return found


def _groups(batches, key):
    """Tables of whole groups from a stream sorted by ``key``; only the open group is carried over."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        keys = table.column(key)
        last = keys[-1]
        if held and held[-1].column(key)[-1] == last:
            held.append(table)
            continue
        cut = pc.index(keys, last).as_py()
        yield pa.concat_tables([*held, table.slice(0, cut)])
        held = [table.slice(cut)]
    if held:
        yield pa.concat_tables(held)


def _sampled(width):
    """Kernel: the shingles of every text, once for each text."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from netsleuth.llm.words import signed, word_chunks

        for batch in batches:
            for a, b, words in word_chunks(batch.column("text"), lower=True):
                flat = np.concatenate([_shingles(words, row, width) for row in range(b - a)])
                yield pa.RecordBatch.from_arrays([pa.array(signed(flat))], names=["key"])

    return run


def common_shingles(docs: DataFrame, width: int):
    """(ids, counts) of the shingles that at least COMMON of SAMPLE documents hold, ordered by id.

    They order the shingles of all documents; SAMPLE bounds the table whatever the size of the input.
    """
    import numpy as np

    every = max(1, docs.count() // SAMPLE)
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(every)) == 0)
    counted = some.select("text").mapInArrow(_sampled(width), "key long").groupBy("key").agg(
        F.count(F.lit(1)).alias("count")).filter(F.col("count") >= COMMON).toArrow()
    ids = np.ascontiguousarray(counted.column("key").to_numpy()).view(np.uint64)
    order = np.argsort(ids)
    return ids[order], counted.column("count").to_numpy()[order]


def _prefix(s, k, common):
    """The ``k`` rarest of the sorted shingles ``s``."""
    import numpy as np

    ids, counts = common
    if not len(ids) or not len(s):
        return s[:k]
    at = np.minimum(np.searchsorted(ids, s), len(ids) - 1)
    held = np.where(ids[at] == s, counts[at], 0)
    return s[np.argsort(held, kind="stable")[:k]]


def _describe(width, num, den, shipped):
    """Kernel: (doc_id, n, cls, bitmap, keys) of every text; keys are the shingles that must meet."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from netsleuth.llm.words import mix, signed, word_chunks

        common = shipped.value
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, words in word_chunks(batch.column("text"), lower=True):
                sizes, classes, bitmaps, keys = [], [], [], []
                for row in range(b - a):
                    s = _shingles(words, row, width)
                    sizes.append(len(s))
                    classes.append(np.sum(mix(s), dtype=np.uint64) ^ np.uint64(len(s)))
                    bitmaps.append(_bitmap(s, _bits_for(len(s), num, den)).tobytes() if len(s) else b"")
                    keys.append(signed(_prefix(s, len(s) + (-num * len(s) // den) + 1, common) if len(s) else s))
                flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(signed(mix(np.array(classes, dtype=np.uint64)))),
                     pa.array(bitmaps, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["doc_id", "n", "cls", "bitmap", "keys"])

    return run


def _shared_keys():
    """Kernel over (key, cls) sorted by both: the distinct rows of keys that more than one class has.

    Streams: of a key with any number of rows it remembers the last class alone.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = None  # (key, class, already known to be shared)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = batch.column("key").to_numpy(zero_copy_only=False)
            cls = batch.column("cls").to_numpy(zero_copy_only=False)
            sent = np.zeros(len(key), dtype=bool)
            if held is not None:
                key, cls = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], cls])
                sent = np.concatenate([[held[2]], sent])
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
            key, cls, sent = key[new], cls[new], sent[new]
            same = key[1:] == key[:-1]
            many = np.zeros(len(key), dtype=bool)
            many[1:] |= same
            many[:-1] |= same
            many |= sent
            out = many & ~sent
            held = (key[-1], cls[-1], bool(many[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(cls[out])], names=["key", "cls"])

    return run


def _tiles(num, den, apart=False):
    """Kernel over tiles sorted by (grp, n, id): candidate links that the bit counts allow.

    With ``apart``, over pairs of blocks sorted by (grp, side, n, id): candidate links between different ``comp``.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def links(table):
            key = table.column("grp").to_numpy()
            ids, sizes = table.column("id").to_numpy(), table.column("n").to_numpy()
            packed = table.column("bitmap").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=int)
            counts = np.diff(np.concatenate([starts, [len(key)]]))
            if apart:
                side, comp = table.column("side").to_numpy(), table.column("comp").to_numpy()
                for s, m in zip(starts, counts):
                    part = slice(s, s + m)
                    for i, j in _across(_Bitmaps(packed[part]), sizes[part], side[part], comp[part], num, den):
                        yield ids[s + i], ids[s + j]
                return
            for s, m in zip(starts[counts > SMALL_GROUP], counts[counts > SMALL_GROUP]):
                for i, j in _walk(_Bitmaps(packed[s:s + m]), sizes[s:s + m], num, den):
                    yield ids[s + i], ids[s + j]
            bits = _Bitmaps(packed)
            for m in range(2, SMALL_GROUP + 1):
                at = starts[counts == m]
                if not len(at):
                    continue
                u, v = np.triu_indices(m, 1)
                for part in np.array_split(at, max(1, len(at) * len(u) // 200_000)):
                    i, j = (part[:, None] + u).ravel(), (part[:, None] + v).ravel()
                    fits = den * sizes[i] >= num * sizes[j]
                    i, j = i[fits], j[fits]
                    fits = (den + num) * bits.apart(i, j) <= (den - num) * (sizes[i] + sizes[j])
                    yield from zip(ids[i[fits]], ids[j[fits]])

        for table in _groups(batches, "grp"):
            found = np.array(list(links(table)), dtype=np.int64).reshape(-1, 2)
            found = np.unique(np.sort(found, axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _verify(width, num, den, apart=False):
    """Kernel over candidate groups sorted by (grp, n, id): links proved on the sorted arrays.

    With ``apart``, over pairs of blocks sorted by (grp, side, n, id): proved links between different ``comp``.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from netsleuth.llm.words import mix, signed, word_chunks

        def links(table):
            ids, sets, kept = [], [], []
            text, want, key = table.column("text"), table.column("cls").to_numpy(), table.column("id").to_numpy()
            side = table.column("side").to_numpy() if apart else np.zeros(len(key), dtype=np.int64)
            done = 0
            for piece in text.chunks:
                for a, b, words in word_chunks(piece, lower=True):
                    for row in range(b - a):
                        s = _shingles(words, row, width)
                        at = done + a + row
                        cls = signed(mix(np.array([np.sum(mix(s), dtype=np.uint64) ^ np.uint64(len(s))], dtype=np.uint64)))[0]
                        # a repeated id brings other rows along; keep the row of this class, once
                        if cls == want[at] and not (ids and ids[-1] == key[at] and side[kept[-1]] == side[at]):
                            ids.append(key[at])
                            sets.append(s)
                            kept.append(at)
                done += len(piece)
            if len(ids) < 2:
                return []
            sizes = np.array([len(s) for s in sets])
            width_bits = 1 << int(min(16, max(9, np.ceil(np.log2(4 * np.median(sizes))))))
            bits = _Bitmaps([_bitmap(s, width_bits).tobytes() for s in sets])

            def reaches(i, j):
                small, large = (sets[i], sets[j]) if sizes[i] <= sizes[j] else (sets[j], sets[i])
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                return den * both >= num * (sizes[i] + sizes[j] - both)

            if apart:
                comp = table.column("comp").to_numpy()[kept]
                return [(ids[i], ids[j]) for i, j in _across(bits, sizes, side[kept], comp, num, den, reaches)]
            return [(ids[i], ids[j]) for i, j in _walk(bits, sizes, num, den, reaches)]

        for table in _groups(batches, "grp"):
            grp = table.column("grp").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])) if len(grp) else []
            found = [x for s, e in zip(starts, [*starts[1:], len(grp)]) for x in links(table.slice(s, e - s))]
            found = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _spanning(placed, load, mass, most, within, across):
    """Links (a, b) that connect, in every unit of ``placed`` (unit, id, n, cls), what comparing all its rows would.

    ``load`` adds what the kernels read to each row. A unit of at most ``most`` of ``mass`` is one group. A larger one is
    dealt into blocks by id; then the smallest id of each set linked so far stands for it, round by round, while that
    halves the rows. What is then still apart is compared in full: each row outside the unit's largest set meets all
    rows of other sets, by pairs of blocks.
    """
    links = "a long, b long"
    sent = lambda df: F.broadcast(df) if df.count() <= MOST_SENT else df
    block = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), blocks)

    def walked(rows):
        hot = written(rows.groupBy("unit").agg(F.ceil(F.sum(mass) / most).alias("blocks")).filter("blocks > 1"), "hot")
        dealt = rows.join(sent(hot), "unit", "left").withColumn(
            "grp", F.when(F.col("blocks").isNull(), F.col("unit")).otherwise(F.xxhash64("unit", block(F.col("blocks"), 5))))
        dealt = load(dealt.select("grp", "n", "id", "cls")).repartition("grp").sortWithinPartitions("grp", "n", "id")
        return written(dealt.mapInArrow(within, links), "links"), hot

    def labelled(rows, found):
        return written(rows.select("unit", "id", "n", "cls").join(components(found), "id", "left").withColumn(
            "comp", F.coalesce("component", "id")).drop("component"), "labelled")

    found, hot = walked(placed)
    if hot.isEmpty():
        return found
    whole = placed.join(sent(hot), "unit")
    rows = named = labelled(whole, found)
    while True:
        sets = rows.groupBy("unit", "comp").agg(F.min(F.struct("id", "n", "cls")).alias("_r")).select("unit", "_r.*", "comp")
        sets = written(sets, "sets")
        if 2 * sets.count() > rows.count():
            break
        found = found.unionByName(walked(sets)[0])
        rows, named = labelled(sets, found), labelled(whole, found)
    sets = named.groupBy("unit", "comp").agg(F.sum(mass).alias("_m"))
    units = written(sets.groupBy("unit").agg(
        F.max_by("comp", F.struct("_m", "comp")).alias("main"), F.count(F.lit(1)).alias("_kinds"),
        F.ceil(F.sum("_m") / most).alias("all"), F.ceil((F.sum("_m") - F.max("_m")) / most).alias("rest")).filter(
        "_kinds > 1").drop("_kinds"), "units")
    if units.isEmpty():
        return found
    own = lambda i, j, side: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(side).alias("side"))
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    asks = F.transform(every(F.col("all")), lambda o: own(block(F.col("rest"), 6), o, 0))
    told = F.transform(every(F.col("rest")), lambda o: own(o, block(F.col("all"), 5), 1))
    pairs = named.join(sent(units), "unit").withColumn(
        "_p", F.explode(F.when(F.col("comp") != F.col("main"), F.concat(asks, told)).otherwise(told)))
    pairs = load(pairs.select(F.xxhash64("unit", "_p.i", "_p.j").alias("grp"), "_p.side", "comp", "n", "id", "cls"))
    pairs = pairs.repartition("grp").sortWithinPartitions("grp", "side", "n", "id")
    return found.unionByName(written(pairs.mapInArrow(across, links), "links"))


def jaccard_components(documents: DataFrame, width: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every document.

    ``class_id`` is the smallest doc_id with the same shingle set, ``component_id`` the
    smallest one reachable over links of similarity ``num / den`` or more. Words are
    lower-cased in A-Z only. Fewer words than ``width`` make one shingle; a null or
    wordless text has an empty set and is alone. Repeated rows fall into one class.
    Rows without doc_id are left out, further columns ignored.
    """
    docs = texts(documents)
    shipped = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width))
    described = written(docs.mapInArrow(
        _describe(width, num, den, shipped), "doc_id long, n long, cls long, bitmap binary, keys array<long>"), "shingles")
    filled = described.filter("n > 0")
    classes = written(filled.groupBy("cls").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "classes")
    keyed = filled.select(F.explode("keys").alias("key"), "cls").repartition("key").sortWithinPartitions("key", "cls")
    shared = keyed.mapInArrow(_shared_keys(), "key long, cls long")
    # by bands of sizes: a set meets its own band and the next larger one, as far as a partner can be
    band = F.floor(F.log("n") / (math.log(den / num) * (1 + 1e-9)))
    bands = F.array(band, band + 1)
    tiles = written(shared.join(classes.select("cls", "n", "id"), "cls"), "tiles")
    large = written(tiles.groupBy("key").count().filter(F.col("count") > TILE_BLOCK).select("key", F.lit(True).alias("_large")), "large")
    tiles = tiles.join(F.broadcast(large) if large.count() <= MOST_SENT else large, "key", "left").withColumn(
        "_band", F.explode(F.when(F.col("_large"), bands).otherwise(F.array(F.lit(None).cast("long")))))
    tiles = tiles.select(F.when(F.col("_large"), F.xxhash64("key", "_band")).otherwise(F.col("key")).alias("unit"), "id", "n", "cls")
    groups = components(_spanning(
        tiles, lambda rows: rows.join(classes.select("id", "bitmap"), "id"), F.lit(1), TILE_BLOCK,
        _tiles(num, den), _tiles(num, den, apart=True)))
    groups = written(groups.select("id", "component"), "groups")
    # the smallest id of a group is a member too
    members = groups.unionByName(groups.select(F.col("component").alias("id"), "component")).distinct()
    members = members.join(classes.select("id", "n", "cls"), "id")
    members = written(members.withColumn("_band", F.explode(bands)).select(
        F.xxhash64("component", "_band").alias("unit"), "id", "n", "cls"), "members")
    linked = components(_spanning(
        members, lambda rows: rows.join(docs, rows["id"] == docs["doc_id"]).drop("doc_id"), F.col("n") + ROW_MASS, GROUP_BLOCK,
        _verify(width, num, den), _verify(width, num, den, apart=True)))
    named = classes.select("cls", F.col("id").alias("class_id")).join(
        linked, F.col("class_id") == linked["id"], "left").select("cls", "class_id", "component")
    return described.select("doc_id", "n", "cls").join(written(named, "named"), "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component", "class_id", "doc_id").alias("component_id"))


def keep_one(documents: DataFrame, width: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows of ``documents`` whose doc_id is the smallest of its near-duplicate group.

    Rows without doc_id have no group and stay.
    """
    kept = jaccard_components(documents, width, num, den).filter("doc_id = component_id").select(
        F.col("doc_id").alias("__llm_kept")).distinct()
    return documents.join(kept, F.col("doc_id") == F.col("__llm_kept"), "left").filter(
        F.col("doc_id").isNull() | F.col("__llm_kept").isNotNull()).select(*documents.columns)
