"""Harmonic packing of tokenised documents into fixed-length sequences.

A piece of length n belongs to class k = capacity // n: its bin takes exactly k pieces.
A document is cut into whole bins first; the rest is one piece where k such pieces fill
a bin to within ``slack`` tokens, otherwise it is cut at the slot length of class k + 1
and the remainder is classed again. Every task fills the bins of all classes on its
own, in one pass without a shuffle; the pieces of bins that its last rows leave open
(fewer than k per class) are packed together, longest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from netsleuth.llm.shared import texts

END_ID = 2
#: Bytes of ids in one batch of rows.
BATCH_BYTES = 8 << 20


def cut_lengths(total: int, capacity: int, slack: int) -> list[int]:
    """Lengths of the pieces of a document of ``total`` ids."""
    out = [capacity] * (total // capacity)
    rest = total % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack:
            out.append(rest)
            break
        slot = capacity // (k + 1)
        out.append(slot)
        rest -= slot
    return out


def first_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``, longest first, each into the first bin with room."""
    import numpy as np

    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    room, bins = np.zeros(len(lengths), dtype=np.int64), []
    for i in order:
        fits = np.flatnonzero(room[:len(bins)] >= lengths[i])
        if len(fits):
            at = int(fits[0])
        else:
            at = len(bins)
            bins.append([])
            room[at] = capacity
        bins[at].append(i)
        room[at] -= lengths[i]
    return bins


def _pack(path, capacity, slack, keep_ids):
    """Kernel: texts of a partition to placed pieces."""

    def run(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        from netsleuth.llm.encode import encoder

        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
        kinds = [pa.int64()] * 7 + [pa.binary()] * keep_ids
        open_bins, rows, used, held_bytes = {}, [], 0, 0
        encode, end = encoder(path).column, END_ID.to_bytes(4, "little")

        def close(pieces):
            nonlocal used, held_bytes
            at = 0
            for piece in pieces:
                rows.append(piece[:5] + (base + used, at) + piece[5:])
                at += piece[2]
            used += 1
            held_bytes += 4 * at * keep_ids

        def flush():
            nonlocal held_bytes
            held_bytes = 0
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids += end
                total, start = len(ids) // 4, 0
                for n in cut_lengths(total, capacity, slack):
                    body = ids[4 * start:4 * (start + n)]
                    piece = (doc_id, start, n, zlib.crc32(body), total) + ((body,) if keep_ids else ())
                    k = capacity // n
                    held = open_bins.setdefault(k, [])
                    held.append(piece)
                    if len(held) == k:
                        close(open_bins.pop(k))
                    start += n
                if len(rows) >= 8192 or held_bytes >= BATCH_BYTES:
                    yield flush()
        left = [piece for k in sorted(open_bins) for piece in open_bins[k]]
        for members in first_fit([piece[2] for piece in left], capacity):
            close([left[i] for i in members])
        if rows:
            yield flush()
        # an idle worker holds no pieces
        encoder(path).forget()

    return run


def pack(documents: DataFrame, path: str, capacity: int = 4096, slack: int | None = None, keep_ids: bool = True) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers. Each
    document's ids end with id 2, so a null or empty text has that id alone. Offsets in a
    sequence start at 0 without gaps; a sequence id names the task in its upper half.
    Rows without doc_id are left out; repeated rows are packed each on its own.
    """
    slack = capacity // 64 if slack is None else slack
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return texts(documents).mapInArrow(_pack(path, capacity, slack, keep_ids), kinds + (", ids binary" if keep_ids else ""))
