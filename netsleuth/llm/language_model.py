"""Bigram language model by deleted interpolation.

Three estimates are mixed for each token: its relative frequency after the word before
it, its relative frequency in the corpus, and a uniform one. The weights depend on how
often the context was seen (a bucket of powers of two) and are learnt by expectation
maximisation on the counts of a held-out part of the training texts, against estimates
from the other part; scores then use the counts of both.

Texts are written once as batches of about ``BATCH`` tokens: word hashes and a token
stream. Each batch sends its distinct words and bigrams, sorted and compressed, to
buckets of the key space, whose number follows the size of the corpus; a bucket adds
the counts of all batches and sends each batch its totals back in the same order. A
frequent bigram is one entry per batch, so no key is hot, and no table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import texts, written

BATCH = 1_500_000
BUCKET_KEYS = 1_500_000
START, END = 0x3C6EF372FE94F82B, 0x510E527FADE682D1
LEVELS = 24
CELLS = 48


def _packed(values):
    """Integers as compressed byte planes."""
    import numpy as np
    import pyarrow as pa

    values = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(planes.tobytes()).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data, kind):
    import numpy as np
    import pyarrow as pa

    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b"", dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _write_batches(batches):
    """Kernel: (batch, role, n, docs, lengths, words, tokens) from (doc_id, role, text)."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    from netsleuth.llm.words import word_chunks

    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    held = {}

    def flush(role):
        nonlocal number
        docs, lengths, hashes = held.pop(role)
        words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        row = [[number], [int(role)], [len(tokens)], [_packed(np.concatenate(docs))], [_packed(np.concatenate(lengths))],
               [_packed(words)], [_packed(tokens.astype(np.uint32).ravel())]]
        number += 1
        kinds = [pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds)], names=["batch", "role", "n", "docs", "lengths", "words", "tokens"])

    for batch in batches:
        ids, roles = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "role"))
        for a, b, words in word_chunks(batch.column("text"), lower=True):
            # each text's words, then its end
            with_end = np.insert(words.hash, words.first[1:], np.uint64(END))
            lengths = (words.counts + 1).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for role in np.unique(roles[a:b]):
                mine = roles[a:b] == role
                part = held.setdefault(role, ([], [], []))
                part[0].append(ids[a:b][mine])
                part[1].append(lengths[mine])
                part[2].append(with_end[np.repeat(mine, lengths)])
                if sum(len(h) for h in part[2]) >= BATCH:
                    yield flush(role)
    for role in sorted(held):
        yield flush(role)


class _Batch:
    """A written batch: its tokens and its sorted keys; odd keys are words, even ones bigrams."""

    def __init__(self, row):
        import numpy as np

        from netsleuth.llm.words import pair

        self.docs, self.lengths = _unpacked(row["docs"], np.int64), _unpacked(row["lengths"], np.int64)
        words, tokens = _unpacked(row["words"], np.uint64), _unpacked(row["tokens"], np.uint32)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        words = np.concatenate([words, [np.uint64(START)]])
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]
        context[self.first] = len(words) - 1
        single = words | np.uint64(1)
        both = pair(words[context], words[tokens]) & ~np.uint64(1)
        bigrams, where = np.unique(both, return_inverse=True)
        self.keys, at = np.unique(np.concatenate([single, bigrams]), return_inverse=True)
        at = at.ravel()
        self.token, self.context = at[tokens], at[context]
        self.bigram = at[len(words):][where.ravel()]

    def counts(self):
        import numpy as np

        out = np.bincount(self.token, minlength=len(self.keys)) + np.bincount(self.bigram, minlength=len(self.keys))
        # the start mark is a context of every text, not a token
        out[self.context[self.first[0]]] += len(self.docs)
        return out.astype(np.uint32)


def _send(buckets):
    """Kernel: (bucket, batch, role, keys, counts) of every batch; keys as differences."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        for table in batches:
            for i in range(table.num_rows):
                row = table.slice(i, 1).to_pylist()[0]
                batch = _Batch(row)
                counts = batch.counts()
                edges = np.searchsorted(batch.keys, _edges(buckets))
                rows = []
                for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if a < b:
                        steps = np.diff(batch.keys[a:b], prepend=np.uint64(0))
                        rows.append((bucket, row["batch"], row["role"], _packed(steps), _packed(counts[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "batch", "role", "keys", "counts"])

    return run


def _edges(buckets):
    """Bounds of the buckets in the key space, one more than there are buckets."""
    import numpy as np

    return np.array([min(-(-(i << 64) // buckets), (1 << 64) - 1) for i in range(buckets + 1)], dtype=np.uint64)


def _add(group):
    """Kernel over a bucket: totals of the main and the held-out part for each batch's keys, and how many words it knows."""
    import numpy as np
    import pyarrow as pa

    rows = group.to_pylist()
    keys = [np.cumsum(_unpacked(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    where = where.ravel()
    counts = [_unpacked(r["counts"], np.uint32) for r in rows]
    total = []
    for role in (0, 1):
        weights = np.concatenate([c if r["role"] == role else np.zeros(len(c), dtype=np.uint32) for c, r in zip(counts, rows)])
        total.append(np.bincount(where, weights=weights, minlength=len(distinct)).astype(np.uint32))
    word = (distinct & np.uint64(1)).astype(bool) & (distinct != np.uint64(START | 1))
    types = int((word & (total[0] + total[1] > 0)).sum())
    out, at = [], 0
    for i, (row, k) in enumerate(zip(rows, keys)):
        mine = where[at:at + len(k)]
        at += len(k)
        out.append((row["batch"], row["bucket"], _packed(total[0][mine]), _packed(total[1][mine]), types if i == 0 else 0))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["batch", "bucket", "main", "held", "types"])


def _returned(left, right):
    """A batch and its totals (main, held) in key order."""
    import numpy as np

    batch = _Batch(left.to_pylist()[0])
    rows = sorted(right.to_pylist(), key=lambda r: r["bucket"])
    return batch, *[np.concatenate([_unpacked(r[c], np.uint32) for r in rows]).astype(np.int64) for c in ("main", "held")]


def _level(counts):
    """Bucket of a context frequency: 0 unseen, then powers of two."""
    import numpy as np

    return np.minimum(np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0), LEVELS - 1)


def _cell(p):
    """Bins of log-probability, 0 for zero."""
    import numpy as np

    return np.where(p > 0, np.minimum(1 + (-2 * np.log2(np.maximum(p, 1e-300))).astype(np.int64), CELLS - 1), 0)


def _events(tokens):
    """Kernel over held-out batches: held-out tokens by level and both estimates from the main part."""

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        names = ["level", "cell2", "cell1", "n", "sum2", "sum1"]
        kinds = [pa.int64()] * 4 + [pa.float64()] * 2
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        batch, main, _ = _returned(left, right)
        seen = main[batch.context]
        p2, p1 = main[batch.bigram] / np.maximum(seen, 1), main[batch.token] / max(1, tokens)
        cell = (_level(seen) * CELLS + _cell(p2)) * CELLS + _cell(p1)
        cells, where, n = np.unique(cell, return_inverse=True, return_counts=True)
        sums = [np.bincount(where.ravel(), weights=p) for p in (p2, p1)]
        columns = [cells // (CELLS * CELLS), cells // CELLS % CELLS, cells % CELLS, n, *sums]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def learn_weights(events, uniform: float, steps: int = 200):
    """(LEVELS, 3) mixture weights (bigram, word, uniform) by expectation maximisation.

    ``events`` has rows (level, n, p2, p1). A level without events keeps the weights of
    the level below it; a context never seen has no bigram estimate.
    """
    import numpy as np

    weights = np.zeros((LEVELS, 3))
    weights[0] = [0.0, 0.9, 0.1]
    for level in range(LEVELS):
        here = events[events[:, 0] == level]
        w = np.array([0.0, 0.9, 0.1]) if level == 0 else np.array([0.4, 0.5, 0.1])
        if len(here):
            p = np.stack([here[:, 2], here[:, 3], np.full(len(here), uniform)], axis=1)
            for _ in range(steps):
                share = p * w
                share /= share.sum(axis=1, keepdims=True)
                new = (share * here[:, 1:2]).sum(axis=0) / here[:, 1].sum()
                if np.abs(new - w).max() < 1e-10:
                    break
                w = new
            # no estimate is ever ruled out
            w = (w * here[:, 1].sum() + np.array([0.0 if level == 0 else 0.01, 0.01, 0.01])) / (
                here[:, 1].sum() + (0.02 if level == 0 else 0.03))
        elif level > 1:
            w = weights[level - 1]
        weights[level] = w
    return weights


def _score(weights, tokens, types):
    """Kernel over a batch and its totals: scores of its documents."""

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        batch, main, held = _returned(left, right)
        total = main + held
        seen, word = total[batch.context], total[batch.token]
        w = weights[_level(seen)]
        p = w[:, 0] * total[batch.bigram] / np.maximum(seen, 1) + w[:, 1] * word / max(1, tokens) + w[:, 2] / (types + 1)
        base = np.log10((word + 1) / (tokens + types + 1))
        add = lambda v: np.add.reduceat(v, batch.first)
        columns = [batch.docs, batch.lengths, add((word > 0).astype(np.int64)), add(base), add(np.log10(p))]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def score_documents(documents: DataFrame, folds: int = 7, test_fold: int = 2, held_fold: int = 5) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    The fold of a document is crc32 of its doc_id as text modulo ``folds``. Training uses
    all folds but ``test_fold``; the mixture weights are learnt on ``held_fold``. Tokens
    are the words, lower-cased in A-Z, and an end mark, so a null or empty text has one.
    ``base_score`` is the add-one word model in log10. Repeated rows count and score each
    on their own; rows without doc_id are left out; other columns are ignored. Without
    any training text every estimate but the uniform one is zero.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    role = F.when(fold == test_fold, 2).when(fold == held_fold, 1).otherwise(0).cast("int")
    docs = texts(documents).select("doc_id", role.alias("role"), "text")
    batches = written(docs.mapInArrow(
        _write_batches, "batch long, role int, n long, docs binary, lengths binary, words binary, tokens binary"), "batches")
    sizes = {r["role"]: r["n"] for r in batches.groupBy("role").agg(F.sum("n").alias("n")).collect()}
    main, held = sizes.get(0, 0), sizes.get(1, 0)
    buckets = max(8, sum(sizes.values()) // BUCKET_KEYS)
    sent = batches.mapInArrow(_send(buckets), "bucket int, batch long, role int, keys binary, counts binary")
    totals = written(sent.groupBy("bucket").applyInArrow(
        _add, "batch long, bucket int, main binary, held binary, types long"), "totals")
    types = totals.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    back = totals.select("batch", "bucket", "main", "held")
    asked = batches.filter("role = 1")
    events = asked.groupBy("batch").cogroup(back.join(asked.select("batch"), "batch", "left_semi").groupBy("batch")).applyInArrow(
        _events(main), "level long, cell2 long, cell1 long, n long, sum2 double, sum1 double")
    # at most LEVELS * CELLS * CELLS rows
    events = events.groupBy("level", "cell2", "cell1").agg(F.sum("n").alias("n"), F.sum("sum2").alias("s2"), F.sum("sum1").alias("s1"))
    import numpy as np

    rows = np.array([(r["level"], r["n"], r["s2"] / r["n"], r["s1"] / r["n"]) for r in events.collect()], dtype=float).reshape(-1, 4)
    weights = learn_weights(rows, 1 / (types + 1))
    scored = batches.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(
        _score(weights, main + held, types), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == test_fold).alias("held_out"),
        "n_tokens", "n_known", F.lit(main + held).cast("long").alias("train_tokens"), "base_score", "score")
