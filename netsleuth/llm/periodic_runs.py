"""Periodic runs of words: block convolutions by an integer transform find the distances, extensions the runs.

A run is a stretch of words with smallest period q, at least ``max(SHORTEST, 3 * q)``
long, that no neighbouring word extends. If ``m = length - q`` of its words equal the
word q places later, then the scale B = 2^k with ``2 * B - 1 <= m <= 4 * B - 2`` has a
whole aligned block of B words inside those m, and q is below ``2 * B``. So at every
scale each block is laid over the 3 * B - 2 words after its first one: the sum of
squared differences at each of the ``2 * B - 1`` distances is one cyclic convolution of
4 * B residues, and is zero where the block occurs again. Sums are exact modulo the
prime ``P``; an occurrence always gives zero, and a zero by chance (one in ``P``) is
refused when the seed is extended on the words themselves. A block with a word that
does not come back within the window occurs nowhere in it and is left out.

Everything works on the words of a few megabytes of texts at once, with a separator
that equals nothing after each text. A text longer than that is a chunk of its own;
memory is some hundred bytes a word of the chunk. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import texts
from netsleuth.llm.words import _power_tables, mix, word_chunks

#: Shortest run in words; a run also holds its period three times.
SHORTEST, TIMES = 24, 3
FIRST_BLOCK = 8
#: Residues in one batch of transforms (a single larger block is a batch of its own).
BATCH = 1 << 19

#: A prime with roots of unity for every power of two up to 2^30; products of residues fit 64 bits.
P, ROOT = 3 * 2**30 + 1, 5
_P = np.uint64(P)

RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"doc_id bigint, n_words bigint, runs array<{RUN}>, kept_text string"

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _mul(a, b):
    product = a * b
    return product - (product // _P) * _P


def _twiddles(h: int, inverse: bool) -> np.ndarray:
    """The first ``h`` powers of a primitive root of unity of order ``2 * h``."""
    if (h, inverse) not in _roots:
        root = pow(ROOT, (P - 1) // (2 * h), P)
        root = pow(root, -1, P) if inverse else root
        out = np.ones(1, dtype=np.uint64)
        while len(out) < h:
            out = np.concatenate([out, _mul(out, np.uint64(pow(root, len(out), P)))])
        _roots[h, inverse] = out
    return _roots[h, inverse]


def forward(x: np.ndarray) -> np.ndarray:
    """Transform of each column, in bit-reversed order; the number of rows is a power of two."""
    n, rows = x.shape
    h = n // 2
    while h:
        v = x.reshape(-1, 2, h, rows)
        a, b = v[:, 0], v[:, 1]
        out = np.empty_like(v)
        total = a + b
        np.minimum(total, total - _P, out=out[:, 0])
        total = a + (_P - b)
        np.minimum(total, total - _P, out=total)
        out[:, 1] = _mul(total, _twiddles(h, False)[:, None])
        x = out.reshape(n, rows)
        h //= 2
    return x


def inverse(x: np.ndarray) -> np.ndarray:
    """From bit-reversed order back to the residues."""
    n, rows = x.shape
    h = 1
    while h < n:
        v = x.reshape(-1, 2, h, rows)
        a, b = v[:, 0], _mul(v[:, 1], _twiddles(h, True)[:, None])
        out = np.empty_like(v)
        total = a + b
        np.minimum(total, total - _P, out=out[:, 0])
        total = a + (_P - b)
        np.minimum(total, total - _P, out=out[:, 1])
        x = out.reshape(n, rows)
        h *= 2
    return _mul(x, np.uint64(pow(n, -1, P)))


def occurrences(values: np.ndarray, squares: np.ndarray, at: np.ndarray, size: int):
    """(block, distance) wherever a block of ``size`` residues occurs again 1 to ``2 * size - 1`` places later.

    ``values`` reaches ``3 * size`` places past each block's start, ``squares`` is the
    running sum of its squares.
    """
    n, step = 4 * size, max(1, BATCH // (4 * size))
    found = []
    for first in range(0, len(at), step):
        some = at[first:first + step]
        pattern = np.zeros((n, len(some)), dtype=np.uint64)
        pattern[:size] = values[some[None, :] + np.arange(size - 1, -1, -1)[:, None]]
        window = np.zeros((n, len(some)), dtype=np.uint64)
        window[:3 * size - 2] = values[some[None, :] + np.arange(1, 3 * size - 1)[:, None]]
        cross = inverse(_mul(forward(pattern), forward(window)))[size - 1:3 * size - 2]
        start = some[None, :] + np.arange(1, 2 * size)[:, None]
        own = (squares[some + size] - squares[some]) % _P
        later = (squares[start + size] - squares[start]) % _P
        distance, which = np.nonzero((own[None, :] + later + 2 * (_P - cross)) % _P == 0)
        found.append((some[which], distance + 1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _seeds(block: np.ndarray, distance: np.ndarray):
    """Without the multiples of a block's smallest distance that continue an unbroken row of them.

    There the stretch has the smaller period, so a larger one is not the smallest.
    """
    order = np.lexsort((distance, block))
    block, distance = block[order], distance[order]
    head = np.concatenate([[True], block[1:] != block[:-1]])
    group = np.cumsum(head) - 1
    least = distance[head][group]
    multiple = distance % least == 0
    before = np.cumsum(multiple)
    rank = before - (before[head] - 1)[group]
    drop = multiple & (distance > least) & (rank == distance // least)
    return block[~drop], distance[~drop]


class _Reach:
    """How far words stay equal to those a distance later, by prefix hashes."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.up, _ = _power_tables(self.n + 1)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(words * self.up[:self.n], out=self.sums[1:])

    def equal(self, at, length, distance):
        here = self.sums[at + length] - self.sums[at]
        return here * self.up[distance] == self.sums[at + distance + length] - self.sums[at + distance]

    def right(self, at, distance, most: int):
        """Equal words from ``at`` on, ``most`` at the highest (rounded up to a power of two less one)."""
        got, step = np.zeros(len(at), np.int64), 1 << max(most.bit_length() - 1, 0)
        while step:
            fits = at + got + step + distance <= self.n
            ok = fits & self.equal(np.where(fits, at + got, 0), np.where(fits, step, 0), np.where(fits, distance, 0))
            got += step * ok
            step //= 2
        return got

    def left(self, at, distance, most: int):
        got, step = np.zeros(len(at), np.int64), 1 << max(most.bit_length() - 1, 0)
        while step:
            fits = at - got - step >= 0
            ok = fits & self.equal(np.where(fits, at - got - step, 0), np.where(fits, step, 0), np.where(fits, distance, 0))
            got += step * ok
            step //= 2
        return got


def _exact(words, start, length, period):
    """Whether every word equals the one a period later, compared one by one."""
    span = length - period
    if not len(span):
        return np.zeros(0, bool)
    ends = np.cumsum(span)
    at = np.repeat(start - (ends - span), span) + np.arange(ends[-1])
    same = words[at] == words[at + np.repeat(period, span)]
    return np.logical_and.reduceat(same, ends - span)


def _word_by_word(words, block, period):
    """The stretch around ``block`` of words equal to those a period later, without hashes."""
    differ = np.flatnonzero(words[:-period] != words[period:])
    k = int(np.searchsorted(differ, block))
    first = int(differ[k - 1]) + 1 if k else 0
    last = int(differ[k]) if k < len(differ) else len(words) - period
    return first, last - first + period


def find_runs(words: np.ndarray, longest: int):
    """(start, length, period) of every run in ``words``, ordered; ``longest`` bounds the words of one text."""
    none = np.zeros((0, 3), dtype=np.int64)
    n = len(words)
    if longest < SHORTEST:
        return none
    # how far ahead each word comes back
    order = np.argsort(words, kind="stable")
    ahead = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
    again = words[order[1:]] == words[order[:-1]]
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    size = FIRST_BLOCK
    whole = n // size
    worst = ahead[:whole * size].reshape(whole, size).max(axis=1)
    reach, values, squares = None, None, None
    found = []
    while 2 * size - 1 <= longest - 1:
        at = np.flatnonzero(worst <= 2 * size - 1) * size
        if len(at):
            if reach is None:
                reach = _Reach(words)
            if values is None or len(values) < n + 3 * size:
                # a power of two at least, so that few scales extend it
                room = 1 << (n + 3 * size).bit_length()
                ends = mix(np.arange(room - n, dtype=np.uint64) + np.uint64(0xA24BAED4963EE407))
                values = np.concatenate([words, ends]) % _P
                squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mul(values, values))])
            block, distance = occurrences(values, squares, at, size)
            inside = block + size + distance <= n
            block, distance = block[inside], distance[inside]
            if len(block):
                block, distance = _seeds(block, distance)
                most = 4 * size
                right = reach.right(block, distance, most)
                left = reach.left(block, distance, most)
                equal = left + right
                # longer ones belong to the next scale, shorter ones to the one before
                good = (right >= size) & (equal >= 2 * size - 1) & (equal <= 4 * size - 2)
                good &= equal + distance >= np.maximum(SHORTEST, TIMES * distance)
                found.append(np.stack([block - left, equal + distance, distance, block], axis=1)[good])
        size *= 2
        half = len(worst) // 2
        worst = np.maximum(worst[0:2 * half:2], worst[1:2 * half:2])
    if not found:
        return none
    runs = np.concatenate(found)
    _, once = np.unique(runs[:, :3], axis=0, return_index=True)
    runs = runs[once]
    true = _exact(words, runs[:, 0], runs[:, 1], runs[:, 2])
    if not true.all():  # hashes met by chance
        anew = np.array([(*_word_by_word(words, b, d), d, b) for _, _, d, b in runs[~true].tolist()], dtype=np.int64)
        anew = anew[anew[:, 1] >= np.maximum(SHORTEST, TIMES * anew[:, 2])]
        runs = np.concatenate([runs[true], anew])
    runs = np.unique(runs[:, :3], axis=0)
    # one stretch, several periods: the others are multiples of the smallest
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _chunk(words):
    """Runs of a chunk's texts, the row of each run, and which words every run leaves."""
    rows = len(words.counts)
    # word i of row r stands at i + r: a separator follows each text
    place = np.arange(len(words.hash)) + words.row_of_word()
    line = mix(np.arange(len(words.hash) + rows, dtype=np.uint64) ^ np.uint64(0xC2B2AE3D27D4EB4F))
    line[place] = words.hash
    runs = find_runs(line, int(words.counts.max(initial=0)))
    begins = words.first[:-1] + np.arange(rows)
    row = np.searchsorted(begins, runs[:, 0], side="right") - 1
    change = np.zeros(len(line) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change)[place] == 0
    return runs[:, 0] - begins[row], runs[:, 1], runs[:, 2], row, kept


def _joined(words, kept):
    """(offsets, bytes) of each text's kept words with one space between them."""
    rows = words.row_of_word()[kept]
    length = words.length[kept]
    n = len(length)
    lead = np.zeros(n, dtype=np.int64)
    lead[1:] = rows[1:] == rows[:-1]
    ends = np.cumsum(length + lead)
    out = np.full(int(ends[-1]) if n else 0, 32, dtype=np.uint8)
    to = ends - length
    if n:
        at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(to, length) + at] = words.data[np.repeat(words.start[kept], length) + at]
    per_row = np.bincount(rows, minlength=len(words.counts))
    last = np.cumsum(per_row)
    offsets = np.concatenate([[0], np.where(last > 0, ends[np.maximum(last - 1, 0)] if n else 0, 0)])
    return offsets.astype(np.int64), out


def _find(batches):
    import pyarrow as pa

    for batch in batches:
        ids = batch.column("doc_id")
        for a, b, words in word_chunks(batch.column("text")):
            start, length, period, row, kept = _chunk(words)
            counts = np.bincount(row, minlength=b - a)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                           ["start", "length", "period"]))
            offsets, data = _joined(words, kept)
            left = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(words.counts, pa.int64()), lists, left],
                ["doc_id", "n_words", "runs", "kept_text"])


def periodic_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) for each row with an id.

    ``runs`` holds (start, length, period) of every run by start, then period; words
    count from 0. ``kept_text`` joins by one space the words that no run holds after
    its first period. A null, empty or blank text has no words, no runs and an empty
    text; repeated rows give repeated results; other columns are ignored. Each text is
    judged by itself: no shuffle.
    """
    return texts(documents).mapInArrow(_find, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The runs of ``periodic_runs`` as counts, the run with most repetitions and checksums."""
    def greater(best, run):
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    best = F.reduce("runs", F.lit(None).cast(RUN), greater)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def plant_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document, by the checksum of its id, ends in a repetition.

    With h the unsigned crc32 of the id's decimal digits and g = floor(h / 10): where
    h % 10 = 0, words from a = g % n on repeat the p = 1 + floor((n - a) / (3 + g % 8))
    words that start at a. Other texts, and texts without words, stay as they are.
    """
    words = F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')")
    cut = (texts(documents)
           .withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
           .withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
           .withColumn("_n", F.size("_w"))
           .withColumn("_g", F.floor(F.col("_h") / 10)))
    placed = cut.withColumn("_a", F.expr("if(_n > 0, cast(_g % _n as int), 0)")).withColumn(
        "_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    tail = F.expr("slice(_w, _a + 1, _p)")
    again = F.expr("cast(ceil((_n - _a) / _p) as int)")
    repeated = F.concat(F.expr("slice(_w, 1, _a)"), F.slice(F.flatten(F.array_repeat(tail, again)), F.lit(1), F.col("_n") - F.col("_a")))
    return placed.select("doc_id", F.when(F.col("_n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
