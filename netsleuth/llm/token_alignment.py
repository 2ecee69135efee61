"""Two tokenisations of one text, aligned where their tokens end at the same byte.

Vocabulary A is a byte-level ``tokenizers`` file, B a ``sentencepiece`` model that puts
a space before each text; A gets the text with that space. Ends of tokens are sorted
lists of byte offsets. The shorter list of a text gallops through the longer: from
where its last end was found it doubles its steps until it is past the next one, then
halves back (``gallop``; many texts, and pieces of a long text, step side by side).
Ends in both lists cut the tokens into groups; the differences of their ranks say which
tokens of either side a group holds. All A-B pairs of a group are links.

``align`` writes, per task and some megabytes of texts, one row with the distinct id
pairs of these texts and, for each text, which of them it holds and how often.
``link_counts`` sums over all texts how many hold a pair. Counts return to a batch as
one row for each of its pairs: the pairs held by more than one document in
``HOT_SHARE``-th of all (text, pair) holdings, at most ``HOT_SHARE`` of them, are
broadcast; a shuffled join serves the others, whose keys are thereby bounded. No text,
token list or group travels.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.encode import Encoder
from netsleuth.llm.shared import texts, written
from netsleuth.session import shuffle_width

#: Bytes of text whose pairs are told apart together; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20
#: Bytes of text aligned in one go.
CHUNK_BYTES = 1 << 20
#: Ends of the shorter list that one lane searches in turn.
LANE = 256
#: Links expanded in one go.
LINKS = 1 << 21
HOT_SHARE = 50_000
#: A row holds megabytes: a file's group of rows, which its writer and its readers hold at once, is one row, not all of a task.
ROW_BY_ROW = {"parquet.block.row.count.limit": 1}

_ALIGNED = ("batch bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
            "n_links array<bigint>, groups_sha256 array<string>, pairs array<bigint>, held array<bigint>, "
            "sizes array<bigint>, which array<int>, times array<bigint>")
SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
          "count_sum bigint, groups_sha256 string")


def gallop(ends: np.ndarray, first, last, low, high):
    """Where the values ``ends[first:last]`` stand in ``ends[low:high]``, for many such pairs of ranges at once.

    Both ranges are sorted. Returns (place of the value, place of the equal one) for the
    values that are found, ordered by place. Each range of values moves on by itself:
    steps double until the next one is reached, then a binary search goes back.
    """
    low = low.copy()
    at = first.copy()
    mine, theirs = [], []
    lanes = np.flatnonzero(at < last)
    while len(lanes):
        value = ends[at[lanes]]
        lo, hi = low[lanes], high[lanes]
        # the first place not below the value lies in (lo + step / 2, lo + step]
        step = np.ones(len(lanes), np.int64)
        going = np.flatnonzero(lo < hi)
        base = lo.copy()
        while len(going):
            probe = base[going] + step[going] - 1
            inside = probe < hi[going]
            below = inside & (ends[np.where(inside, probe, 0)] < value[going])
            going = going[below]
            base[going] += step[going]
            step[going] *= 2
        top = np.minimum(base + step - 1, hi)
        while True:
            open_ = base < top
            if not open_.any():
                break
            middle = (base + top) // 2
            less = open_ & (ends[np.where(open_, middle, 0)] < value)
            base = np.where(less, middle + 1, base)
            top = np.where(open_ & ~less, middle, top)
        found = base < hi
        found &= ends[np.where(found, base, 0)] == value
        mine.append(at[lanes][found])
        theirs.append(base[found])
        low[lanes] = base
        at[lanes] += 1
        lanes = lanes[(at[lanes] < last[lanes]) & (base < hi)]
    if not mine:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mine, theirs = np.concatenate(mine), np.concatenate(theirs)
    order = np.argsort(mine, kind="stable")
    return mine[order], theirs[order]


def common_ends(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray):
    """Ranks (in A, in B) of the ends that both lists of a text hold, over all texts.

    ``first_a[t]:first_a[t + 1]`` is text t's range of ``ends_a``; likewise B. The
    shorter list of each text drives, cut into lanes of ``LANE`` ends.
    """
    shift = len(ends_a)
    ends = np.concatenate([ends_a, ends_b])
    a_drives = np.diff(first_a) <= np.diff(first_b)
    drive = np.where(a_drives, first_a[:-1], first_b[:-1] + shift), np.where(a_drives, first_a[1:], first_b[1:] + shift)
    other = np.where(a_drives, first_b[:-1] + shift, first_a[:-1]), np.where(a_drives, first_b[1:] + shift, first_a[1:])
    lanes = -(-(drive[1] - drive[0]) // LANE)
    text = np.repeat(np.arange(len(lanes)), lanes)
    number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    first = drive[0][text] + number * LANE
    mine, theirs = gallop(ends, first, np.minimum(first + LANE, drive[1][text]), other[0][text], other[1][text])
    flip = mine >= shift
    in_a, in_b = np.where(flip, theirs, mine), np.where(flip, mine, theirs) - shift
    order = np.argsort(in_a, kind="stable")
    return in_a[order], in_b[order]


class Spelled:
    """Token ids with the bytes each stands for."""

    def __init__(self, spelling: list[bytes]):
        self.length = np.fromiter(map(len, spelling), np.int64, len(spelling))
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(spelling), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        return self.data[np.repeat(self.start[ids], length) + at]


def byte_level_bytes(token: str) -> bytes:
    """The bytes a byte-level token spells; a token with other signs stands for itself."""
    try:
        return bytes(_BYTE_OF[c] for c in token)
    except KeyError:
        return token.encode()


def _byte_signs() -> dict[str, int]:
    # printable bytes stand for themselves, the others for the code points from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


_BYTE_OF = _byte_signs()


def piece_bytes(piece: str) -> bytes:
    """The bytes a sentence piece spells: U+2581 is a space, <0xHH> a byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Pair:
    """Both vocabularies of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Encoder(path_a)
        # their strings inside a text are ordinary text
        self.a.library.encode_special_tokens = True
        size = self.a.library.get_vocab_size()
        self.spelled_a = Spelled([byte_level_bytes(self.a.library.id_to_token(i) or "") for i in range(size)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.spelled_b = Spelled([piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())])
        self.shift = size
        numbers = [str(i).encode() for i in range(max(size, self.b.get_piece_size()))]
        # a token's number with the sign that follows it
        self.said = [n + sign for sign in (b",", b"|", b";") for n in numbers]
        self.numbers = len(numbers)

    def tokens(self, texts_: list[str]):
        """(ids A, first of each text, ids B, first of each text); texts that do not come back have none."""
        import pyarrow as pa

        spaced = pa.array([" " + t if t else "" for t in texts_], pa.large_string())
        coded = list(self.a.column(spaced))
        ids_a = np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int64)
        n_a = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
        pieces = [self.b.encode(t, num_threads=1) if t else [] for t in texts_]
        n_b = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids_b = np.fromiter((i for p in pieces for i in p), np.int64, int(n_b.sum()))
        want = [s.encode() for s in spaced.to_pylist()]
        good = np.array([
            bool(t) and self._spells(self.spelled_a, ids_a[i:j], w) and self._spells(self.spelled_b, ids_b[k:m], w)
            for t, w, i, j, k, m in zip(texts_, want, np.cumsum(n_a) - n_a, np.cumsum(n_a), np.cumsum(n_b) - n_b, np.cumsum(n_b))],
            dtype=bool)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        zero = np.zeros(1, np.int64)
        return (ids_a, np.concatenate([zero, np.cumsum(n_a * good)]), ids_b, np.concatenate([zero, np.cumsum(n_b * good)]))

    @staticmethod
    def _spells(spelled, ids, want: bytes) -> bool:
        return int(spelled.length[ids].sum()) == len(want) and spelled.joined(ids).tobytes() == want


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def groups(pair: Pair, texts_: list[str]):
    """Tokens and groups of some texts.

    Returns ids A, ids B, the rank after each group's last token in A and in B, and
    the first group of each text (one more entry than texts).
    """
    ids_a, first_a, ids_b, first_b = pair.tokens(texts_)
    spelled = pair.spelled_a.length[ids_a], pair.spelled_b.length[ids_b]
    # ends count from the first byte of the first text; both sides spell the same bytes
    last_a, last_b = common_ends(np.cumsum(spelled[0]), first_a, np.cumsum(spelled[1]), first_b)
    return ids_a, ids_b, last_a + 1, last_b + 1, np.searchsorted(last_a, first_a), first_a, first_b


def _said(pair: Pair, ids_a, ids_b, end_a, end_b, k, m):
    """``a1,a2|b1;a3|b2,b3`` of the groups k to m."""
    if k == m:
        return b""
    from_a, from_b = (int(end_a[k - 1]), int(end_b[k - 1])) if k else (0, 0)
    a, b = ids_a[from_a:end_a[m - 1]].copy(), ids_b[from_b:end_b[m - 1]].copy()
    a[end_a[k:m] - 1 - from_a] += pair.numbers
    b[end_b[k:m] - 1 - from_b] += 2 * pair.numbers
    # a group's A tokens stand before its B tokens
    n_a, n_b = np.diff(end_a[k:m], prepend=from_a), np.diff(end_b[k:m], prepend=from_b)
    out = np.empty(len(a) + len(b), dtype=np.int64)
    out[np.arange(len(a)) + np.repeat(np.cumsum(n_b) - n_b, n_a)] = a
    out[np.arange(len(b)) + np.repeat(np.cumsum(n_a), n_b)] = b
    return b"".join(map(pair.said.__getitem__, out.tolist()))[:-1]


def _links(pair: Pair, ids_a, ids_b, end_a, end_b, row, rows):
    """Distinct (text, id pair) with their numbers of links, a bounded number of links at a time."""
    n_a, n_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    # one A token faces all B tokens of its group
    group = np.repeat(np.arange(len(n_a)), n_a)
    ends = np.cumsum(n_b[group])
    total, done, before = int(ends[-1]) if len(ends) else 0, 0, 0
    parts = []
    while done < len(group):
        upto = max(int(np.searchsorted(ends, before + LINKS, side="right")), done + 1)
        some = group[done:upto]
        count = n_b[some]
        a = np.repeat(np.arange(done, upto), count)
        inner = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        b = np.repeat(end_b[some] - n_b[some], count) + inner
        key = ids_a[a] * pair.numbers + ids_b[b]
        parts.append(_counted(row[np.repeat(some, count)], key, np.ones(len(key), np.int64)))
        done, before = upto, int(ends[upto - 1])
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    return _counted(*(np.concatenate([p[i] for p in parts]) for i in range(3)))


def _counted(row, key, times):
    """Sums of ``times`` over equal (row, key), ordered."""
    order = np.lexsort((key, row))
    row, key, times = row[order], key[order], times[order]
    head = np.ones(len(key), bool)
    head[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    return row[at], key[at], np.add.reduceat(times, at) if len(at) else times


class _Batch:
    """Results of some texts until their distinct pairs are numbered together."""

    def __init__(self):
        self.size = 0
        self.columns = {name: [] for name in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        self.sizes, self.keys, self.times = [], [], []

    def add(self, pair: Pair, ids: list, texts_: list[str]):
        import hashlib

        ids_a, ids_b, end_a, end_b, first, first_a, first_b = groups(pair, texts_)
        rows = len(texts_)
        n_groups = np.diff(first)
        row, key, times = _links(pair, ids_a, ids_b, end_a, end_b, np.repeat(np.arange(rows), n_groups), rows)
        links = np.bincount(row, weights=times, minlength=rows).astype(np.int64)
        edges = first.tolist()
        shas = [hashlib.sha256(_said(pair, ids_a, ids_b, end_a, end_b, k, m)).hexdigest() if m > k else ""
                for k, m in zip(edges, edges[1:])]
        for name, values in zip(self.columns, (ids, np.diff(first_a), np.diff(first_b), n_groups, links, shas)):
            self.columns[name].append(values)
        self.sizes.append(np.bincount(row, minlength=rows))
        self.keys.append(key)
        self.times.append(times)

    def record(self, number: int):
        import pyarrow as pa

        keys = np.concatenate(self.keys)
        pairs, which = np.unique(keys, return_inverse=True)
        # texts of the batch that hold a pair
        held = np.bincount(which, minlength=len(pairs))
        data = {name: np.concatenate(parts) if name != "groups_sha256" else [s for p in parts for s in p]
                for name, parts in self.columns.items()}
        data |= {"pairs": pairs, "held": held, "sizes": np.concatenate(self.sizes), "which": which.astype(np.int32),
                 "times": np.concatenate(self.times)}
        kinds = {"groups_sha256": pa.string(), "which": pa.int32()}
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, kinds.get(k, pa.int64())))
                 for k, v in data.items()]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], ["batch", *data])


def _align(batches, path_a, path_b):
    from pyspark import TaskContext

    pair = _pair(path_a, path_b)
    number = TaskContext.get().partitionId() << 32
    batch = _Batch()
    for rows in batches:
        for ids, texts_, size in _portions(rows):
            if batch.size and batch.size + size > BATCH_BYTES:
                yield batch.record(number)
                number, batch = number + 1, _Batch()
            batch.add(pair, ids, texts_)
            batch.size += size
    if batch.size or batch.sizes:
        yield batch.record(number)


def _portions(rows):
    """(ids, texts, bytes) of about ``CHUNK_BYTES``, one text at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        before = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
        yield (rows.column("doc_id").slice(a, b - a).to_numpy(),
               [t or "" for t in rows.column("text").slice(a, b - a).to_pylist()], int(ends[b - 1]) - before)
        a = b


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each batch of texts (see the module), written to the shared folder."""
    def run(batches):
        yield from _align(batches, path_a, path_b)

    return written(texts(documents).mapInArrow(run, _ALIGNED), "aligned", **ROW_BY_ROW)


def link_counts(aligned: DataFrame, numbers: int) -> DataFrame:
    """(pair, documents, best): how many documents hold a linked pair, and whether no pair of its A id has more.

    A pair is ``id A * numbers + id B``. Counts are summed before the shuffle; an A id
    has at most as many pairs as B has tokens, and the table of A's maxima at most as
    many rows as A has tokens, which is what is broadcast.
    """
    counts = written(aligned.select(F.explode(F.arrays_zip("pairs", "held")).alias("_z"))
                     .groupBy(F.col("_z.pairs").alias("pair")).agg(F.sum("_z.held").alias("documents")), "pairs")
    counts = counts.withColumn("_a", F.expr(f"pair div {numbers}"))
    most = counts.groupBy("_a").agg(F.max("documents").alias("_most"))
    return counts.join(F.broadcast(most), "_a").select("pair", "documents", (F.col("documents") == F.col("_most")).alias("best"))


def _score(batch, counts):
    """The texts of one batch with their sums over the counts of its pairs."""
    import pyarrow as pa

    order = np.argsort(counts.column("pair").to_numpy())
    documents = counts.column("documents").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    out = []
    for i in range(batch.num_rows):
        take = lambda name: batch.column(name)[i].values
        which, times = take("which").to_numpy(), take("times").to_numpy()
        ends = np.concatenate([[0], np.cumsum(take("sizes").to_numpy())])

        def total(values):
            sums = np.concatenate([[0], np.cumsum(values * times)])
            return pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())

        names = ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        cells = {n: take(n) for n in names}
        out.append(pa.Table.from_arrays(
            [cells["doc_ids"], cells["n_a"], cells["n_b"], cells["n_groups"], cells["n_links"], total(best[which]),
             total(documents[which]), cells["groups_sha256"]],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
    return pa.concat_tables(out) if out else None


def alignment(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment of every row with an id: numbers of tokens, groups and links, and sums over corpus-wide counts.

    ``n_best`` counts the links whose pair no other pair of the same A id outnumbers,
    ``count_sum`` sums the counts of all links. A text that is null or empty, or that
    either vocabulary does not give back byte for byte, has no tokens and zeros.
    Repeated rows are documents of their own; other columns are ignored.
    """
    import pyarrow as pa
    from tokenizers import Tokenizer
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    numbers = max(Tokenizer.from_file(path_a).get_vocab_size(), size_b)
    aligned = align(documents, path_a, path_b)
    counts = written(link_counts(aligned, numbers), "counts")
    asked = aligned.select(F.col("batch").alias("of"), F.explode("pairs").alias("pair"))
    total = counts.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    # fewer than HOT_SHARE pairs can each have more than one holding in HOT_SHARE
    hot = F.col("documents") > total // HOT_SHARE
    common = counts.filter(hot)
    marked = asked.join(F.broadcast(common), "pair", "left")
    rare = marked.filter(F.col("documents").isNull()).select("of", "pair").join(counts.filter(~hot), "pair")
    met = marked.filter(F.col("documents").isNotNull()).select("of", "pair", "documents", "best").unionByName(
        rare.select("of", "pair", "documents", "best"))

    empty = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                       ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def score(left, right):
        table = _score(left.combine_chunks(), right.combine_chunks())
        return empty.empty_table() if table is None else table

    # about a batch a task: the few dozen megabytes of a batch are small once compressed, so that the session would join many
    width = max(shuffle_width(documents.sparkSession), aligned.count())
    return aligned.repartition(width, "batch").groupBy("batch").cogroup(
        met.repartition(width, "of").groupBy("of")).applyInArrow(score, SCHEMA)
