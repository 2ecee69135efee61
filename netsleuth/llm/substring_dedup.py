"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping blocks of ``block`` words, which are the
index; all its rolling windows of ``block`` words probe it. A block or window travels
under the smallest hash of the ``GRAM``-word runs inside it, so neighbouring windows
share one probe row (about one for nine words). A key held by two different texts is a
hit. Hits are extended: a run of consecutive hit windows, anchored on a block of a
smaller doc_id, may hold maximal exact repeats, and its windows of ``width`` words are
compared exactly by a grouped minimum of doc_id. Since every window of 2 * block words
or more covers a whole block of its source, no repeat of ``width`` words is missed.

Texts equal to an earlier one collapse first. Hot passages meet only in grouped
minima, which combine map-side, and in joins with one written row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import texts, written

GRAM = 8


def _describe(batches):
    """Kernel: words and digest of every whole text."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        n, sha = [], []
        for text in batch.column("text"):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("cls"), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
            names=["doc_id", "cls", "n", "sha"])


def _window_keys(hashes, block):
    """Smallest GRAM-word hash inside every window of ``block`` words."""
    import numpy as np

    from netsleuth.llm.words import windows

    low, span, size = windows(hashes, GRAM), block - GRAM + 1, 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:]) if len(low) > size else low[:0]
        size *= 2
    rest = span - size
    if rest:
        low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
    return low


def _anchors(width, block):
    """Kernel: one row per run of neighbouring windows with the same key; ``block`` if a reference block is among them."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from netsleuth.llm.words import signed, word_chunks

        for batch in batches:
            doc, cls = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "cls"))
            for a, b, words in word_chunks(batch.column("text")):
                keys = _window_keys(words.hash, block)
                if not len(keys):
                    continue
                row = words.row_of_word()
                place = np.arange(len(keys)) - words.first[row[:len(keys)]]
                whole = (row[:len(keys)] == row[block - 1:]) & (words.counts[row[:len(keys)]] >= width)
                at = np.flatnonzero(whole)
                if not len(at):
                    continue
                keys, row, aligned = keys[at], row[at], place[at] % block == 0
                start = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(keys[start])), pa.array(doc[a + row[start]]), pa.array(cls[a + row[start]]),
                     pa.array(np.logical_or.reduceat(aligned, start))], names=["key", "doc_id", "cls", "block"])

    return run


def _candidates(width, block):
    """Kernel: hashes of the ``width``-word windows that lie inside runs of hits."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from netsleuth.llm.words import pair, signed, windows, word_chunks

        span = width - block + 1
        every = lambda mask: np.convolve(mask, np.ones(span, dtype=np.int64), "valid") if len(mask) >= span else mask[:0]
        for batch in batches:
            doc, cls = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "cls"))
            hits = [batch.column(c) for c in ("later", "anchored", "earlier")]
            for a, b, words in word_chunks(batch.column("text")):
                for r in range(b - a):
                    h = words.hash[words.first[r]:words.first[r + 1]]
                    if len(h) < width:
                        continue
                    keys = signed(_window_keys(h, block))
                    later, anchored, earlier = (
                        np.isin(keys, c[a + r].values.to_numpy(zero_copy_only=False)).astype(np.int64) for c in hits)
                    take = (every(later) == span) & (every(anchored) > 0) | (every(earlier) == span)
                    at = np.flatnonzero(take)
                    if not len(at):
                        continue
                    first = windows(h, width)[at]
                    second = windows(pair(h, h), width)[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(first)), pa.array(signed(second)), pa.array(np.full(len(at), doc[a + r])),
                         pa.array(np.full(len(at), cls[a + r])), pa.array(at.astype(np.int64))],
                        names=["ha", "hb", "doc_id", "cls", "pos"])

    return run


def _cut(width):
    """Kernel: spans covered by the given windows, and the text without them."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            starts, ends, removed, kept, sha = [], [], [], [], []
            for text, at in zip(batch.column("text"), batch.column("at")):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                step = np.zeros(len(words) + 1, dtype=np.int64)
                at = at.values.to_numpy(zero_copy_only=False)
                np.add.at(step, at, 1)
                np.add.at(step, at + width, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                starts.append(np.flatnonzero(edge == 1).tolist())
                ends.append(np.flatnonzero(edge == -1).tolist())
                left = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                removed.append(int(gone.sum()))
                kept.append(left.decode("utf-8", "surrogatepass"))
                sha.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("cls"), pa.array(starts, pa.list_(pa.int64())),
                 pa.array(ends, pa.list_(pa.int64())), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(sha, pa.string())], names=["doc_id", "cls", "starts", "ends", "n_removed", "kept", "sha"])

    return run


def repeated(documents: DataFrame, width: int = 50, block: int = 25) -> tuple[DataFrame, DataFrame]:
    """(described, changed): every text and those that lose words.

    ``described`` has (doc_id, cls, n, sha, first): ``cls`` hashes the text, ``first``
    is the smallest doc_id with the same text. ``changed`` has (doc_id, cls, starts,
    ends, n_removed, kept, sha): maximal spans of words [start, end) covered by windows
    of ``width`` words that also start in a document of smaller doc_id, and the rest
    joined by single spaces. Copies of an earlier text are not in ``changed``; all their
    words are repeats if they have ``width`` or more. Null texts have no words; rows of
    one doc_id never remove each other's words; rows without doc_id are left out.
    """
    if width < 2 * block - 1 or block < GRAM:
        raise ValueError("width must be at least 2 * block - 1, and block at least the gram length")
    docs = texts(documents).withColumn("cls", F.xxhash64("text"))
    described = written(docs.mapInArrow(_describe, "doc_id long, cls long, n long, sha string"), "described")
    firsts = written(described.groupBy("cls").agg(F.min("doc_id").alias("first")), "firsts")
    described = described.join(firsts, "cls", "left").select("doc_id", "cls", "n", "sha", "first")

    anchors = written(docs.mapInArrow(
        _anchors(width, block), "key long, doc_id long, cls long, block boolean"), "anchors")
    keys = anchors.groupBy("key").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        F.min(F.when(F.col("block"), F.col("doc_id"))).alias("ref"), F.min("cls").alias("_c1"), F.max("cls").alias("_c2"))
    keys = written(keys.filter("_c1 < _c2").drop("_c1", "_c2"), "keys")
    hits = anchors.join(keys, "key")
    mine = lambda cond: F.collect_set(F.when(cond, F.col("key")))
    hits = hits.groupBy("doc_id", "cls").agg(
        mine(F.col("lo") < F.col("doc_id")).alias("later"), mine(F.col("ref") < F.col("doc_id")).alias("anchored"),
        mine(F.col("hi") > F.col("doc_id")).alias("earlier"))
    # a copy of an earlier text needs no search and is no first source
    hits = hits.join(firsts, "cls").filter("doc_id = first").select("doc_id", "cls", "later", "anchored", "earlier")
    found = written(hits.join(docs, ["doc_id", "cls"]).mapInArrow(
        _candidates(width, block), "ha long, hb long, doc_id long, cls long, pos long"), "windows")
    shared = found.groupBy("ha", "hb").agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"))
    shared = written(shared.filter("_lo < _hi").select("ha", "hb", "_lo"), "shared")
    covered = found.join(shared, ["ha", "hb"]).filter("doc_id > _lo").groupBy("doc_id", "cls").agg(
        F.collect_set("pos").alias("at"))
    changed = covered.join(docs, ["doc_id", "cls"]).dropDuplicates(["doc_id", "cls"]).mapInArrow(
        _cut(width), "doc_id long, cls long, starts array<long>, ends array<long>, n_removed long, kept string, sha string")
    return described, written(changed, "changed")


def digest(documents: DataFrame, width: int = 50, block: int = 25) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, from :func:`repeated`."""
    described, changed = repeated(documents, width, block)
    changed = changed.select("doc_id", "cls", "n_removed", F.col("sha").alias("_sha"))
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n") >= width)
    return described.join(changed, ["doc_id", "cls"], "left").select(
        "doc_id", F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_sha", "sha")).alias("kept_sha256"))


def remove_repeats(documents: DataFrame, width: int = 50, block: int = 25) -> DataFrame:
    """``documents`` with the repeated words cut out; texts without repeats stay as they are.

    A document whose words are all repeats keeps its row with an empty text. Where the
    table has ``n_chars``, it is counted anew for changed texts.
    """
    described, changed = repeated(documents, width, block)
    copies = described.filter((F.col("doc_id") > F.col("first")) & (F.col("n") >= width)).select(
        "doc_id", "cls", F.lit("").alias("kept")).distinct()
    new = changed.select("doc_id", "cls", "kept").unionByName(copies).select(
        F.col("doc_id").alias("__llm_id"), F.col("cls").alias("__llm_cls"), F.col("kept").alias("__llm_kept"))
    joined = documents.join(new, (F.col("doc_id").cast("long") == F.col("__llm_id")) & (F.xxhash64("text") == F.col("__llm_cls")), "left")
    out = {"text": F.coalesce("__llm_kept", "text")}
    if "n_chars" in documents.columns:
        out["n_chars"] = F.when(F.col("__llm_kept").isNotNull(), F.length("__llm_kept").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in documents.columns])
