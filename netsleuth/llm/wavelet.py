"""Token files as wavelet matrices: bit-planes with rank and select.

Documents are range-partitioned by doc_id; each partition writes one compressed shard
file of segments of about ``SEGMENT`` ids. A segment holds its sorted alphabet, one
bit-plane per bit of a symbol, the number of zeros of each plane and the count of ones
before every 512 bits. Access, counting and finding occurrences read these planes only.
The files are Parquet rows in a folder that Spark writes, so any store it reaches will do.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsleuth.llm.shared import ship, texts

END_ID = 2
SEGMENT = 1 << 20
RANK_BITS = 512

SCHEMA = ("shard long, segment long, n long, doc_ids binary, ends binary, alphabet binary, "
          "planes array<binary>, zeros array<long>, ranks array<binary>")


class WaveletMatrix:
    """A sequence of symbols as bit-planes, highest bit first."""

    def __init__(self, n, alphabet, planes, zeros, ranks):
        self.n, self.alphabet, self.planes, self.zeros, self.ranks = n, alphabet, planes, zeros, ranks

    @classmethod
    def build(cls, ids):
        import numpy as np

        present = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=bool)
        present[ids] = True
        alphabet = np.flatnonzero(present).astype("<u4")
        place = np.zeros(len(present), dtype=np.uint32)
        place[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
        codes = place[ids]
        if len(alphabet) <= 1 << 16:
            codes = codes.astype(np.uint16)
        planes, zeros, ranks = [], [], []
        for k in reversed(range(max(1, int(len(alphabet) - 1).bit_length()))):
            bit = (codes & codes.dtype.type(1 << k)) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(packed)
            zeros.append(len(codes) - int(np.count_nonzero(bit)))
            ranks.append(cls._ranks(packed))
            codes = np.concatenate([codes.compress(~bit), codes.compress(bit)])
        return cls(len(ids), alphabet, planes, zeros, ranks)

    @staticmethod
    def _ranks(packed):
        import numpy as np

        step = RANK_BITS // 8
        ones = np.bitwise_count(packed).astype(np.uint32)
        blocks = np.add.reduceat(ones, np.arange(0, len(ones), step)) if len(ones) else ones
        return np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")

    def _bits(self, level):
        import numpy as np

        return np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)

    def all(self):
        """Every symbol in order."""
        import numpy as np

        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        codes = np.zeros(self.n, dtype=kind)
        depth = len(self.planes)
        for level in reversed(range(depth)):
            bit, zeros = self._bits(level), self.zeros[level]
            up = np.empty_like(codes)
            up[np.flatnonzero(~bit)] = codes[:zeros]
            up[np.flatnonzero(bit)] = codes[zeros:] | kind(1 << (depth - 1 - level))
            codes = up
        return self.alphabet[codes]

    def _ones_before(self, level, i):
        """How many ones stand in a plane before position ``i``."""
        import numpy as np

        block = i // RANK_BITS
        first = block * RANK_BITS // 8
        part = self.planes[level][first:-(-i // 8)]
        count = int(self.ranks[level][block])
        if len(part):
            count += int(np.bitwise_count(part).sum())
            if i % 8:
                count -= int(np.bitwise_count(part[-1] >> np.uint8(i % 8)))
        return count

    def access(self, i: int) -> int:
        code = 0
        for level in range(len(self.planes)):
            bit = (int(self.planes[level][i // 8]) >> (i % 8)) & 1
            code = code << 1 | bit
            ones = self._ones_before(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return int(self.alphabet[code])

    def _code(self, symbol: int):
        import numpy as np

        at = int(np.searchsorted(self.alphabet, symbol))
        return at if at < len(self.alphabet) and self.alphabet[at] == symbol else None

    def _range(self, code, a, b):
        """Where the symbols [a, b) equal to ``code`` stand below the last plane."""
        depth = len(self.planes)
        for level in range(depth):
            one_a, one_b = self._ones_before(level, a), self._ones_before(level, b)
            if code >> (depth - 1 - level) & 1:
                a, b = self.zeros[level] + one_a, self.zeros[level] + one_b
            else:
                a, b = a - one_a, b - one_b
        return a, b

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` stands before position ``i``."""
        code = self._code(symbol)
        if code is None:
            return 0
        a, b = self._range(code, 0, i)
        return b - a

    def occurrences(self, symbol: int):
        """All positions of ``symbol``, ascending."""
        import numpy as np

        code = self._code(symbol)
        if code is None:
            return np.zeros(0, dtype=np.int64)
        a, b = self._range(code, 0, self.n)
        at = np.arange(a, b)
        depth = len(self.planes)
        for level in reversed(range(depth)):
            bit = self._bits(level)
            # the j-th zero or one of the plane above
            at = np.flatnonzero(bit)[at - self.zeros[level]] if code >> (depth - 1 - level) & 1 else np.flatnonzero(~bit)[at]
        return np.sort(at)

    def _place(self, level, j, one):
        """Position of the j-th one or zero of a plane, from 0: its block from the stored counts, then the bits of that block."""
        import numpy as np

        ranks = self.ranks[level]
        before = lambda block: int(ranks[block]) if one else block * RANK_BITS - int(ranks[block])
        block = bisect.bisect_right(range(len(ranks)), j, key=before) - 1
        first = block * RANK_BITS
        bits = np.unpackbits(self.planes[level][first // 8:(first + RANK_BITS) // 8], bitorder="little")
        return first + int(np.flatnonzero(bits == one)[j - before(block)])

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th ``symbol`` from 0, or -1; one block of each plane is read."""
        code = self._code(symbol)
        if code is None:
            return -1
        a, b = self._range(code, 0, self.n)
        if not 0 <= k < b - a:
            return -1
        at, depth = a + k, len(self.planes)
        for level in reversed(range(depth)):
            one = code >> (depth - 1 - level) & 1
            at = self._place(level, at - self.zeros[level] * one, one)
        return at


def _encode(path):
    """Kernel over a sorted partition: its texts as segments of a shard."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from netsleuth.llm.encode import encoder

        context = TaskContext.get()
        shard, segment = context.partitionId() if context else 0, 0
        encode, end = encoder(path).column, END_ID.to_bytes(4, "little")
        docs, bodies, size = [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(bodies), dtype="<u4")
            ends = np.cumsum([len(b) // 4 for b in bodies]).astype("<i8")
            m = WaveletMatrix.build(ids)
            row = {"shard": [shard], "segment": [segment], "n": [m.n], "doc_ids": [np.array(docs, dtype="<i8").tobytes()],
                   "ends": [ends.tobytes()], "alphabet": [m.alphabet.tobytes()], "planes": [[p.tobytes() for p in m.planes]],
                   "zeros": [m.zeros], "ranks": [[r.tobytes() for r in m.ranks]]}
            kinds = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                docs.append(doc_id)
                bodies.append(ids + end)
                size += len(ids) // 4 + 1
                # an Arrow column of one row holds any document whole
                if size >= SEGMENT:
                    yield flush()
                    docs, bodies, size, segment = [], [], 0, segment + 1
        if docs:
            yield flush()

    return run


def _matrix(row):
    import numpy as np

    as_ints = lambda name, kind: np.frombuffer(row[name], dtype=kind)
    matrix = WaveletMatrix(row["n"], as_ints("alphabet", "<u4"), [np.frombuffer(p, dtype=np.uint8) for p in row["planes"]],
                           row["zeros"], [np.frombuffer(r, dtype="<u4") for r in row["ranks"]])
    return matrix, as_ints("doc_ids", "<i8"), as_ints("ends", "<i8")


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _digests(batches):
    """Kernel: documents of each segment, decoded whole."""
    import zlib

    import numpy as np
    import pyarrow as pa

    for row in _rows(batches):
        matrix, doc_ids, ends = _matrix(row)
        ids = matrix.all().astype("<u4").tobytes()
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        crc = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
        n = len(doc_ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, row["shard"])), pa.array(np.full(n, row["segment"])), pa.array(doc_ids), pa.array(starts),
             pa.array(ends - starts), pa.array(crc, pa.int64())],
            names=["shard", "segment", "doc_id", "at", "n_tokens", "ids_crc32"])


def _occurrences(symbol):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for row in _rows(batches):
            matrix, doc_ids, ends = _matrix(row)
            at = matrix.occurrences(symbol)
            doc = np.searchsorted(ends, at, side="right")
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids[doc]), pa.array(at - starts[doc])], names=["doc_id", "position"])

    return run


def write_tokens(documents: DataFrame, path: str, folder: str) -> None:
    """Encode every text, end it with id 2 and write the shards to ``folder``.

    Ids stand in ascending doc_id order over shards and segments; texts of one doc_id
    stand in the order of their hash. A null text is empty; rows without doc_id are left
    out. ``path`` is the tokenizer's file.
    """
    docs = texts(documents).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    docs.mapInArrow(_encode(path), SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.read.schema(SCHEMA).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    shards = read_shards(spark, folder)
    sizes = shards.select("shard", "segment", "n")
    before = lambda *by: Window.partitionBy(*by).orderBy("segment" if by else "shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard file
    whole = sizes.groupBy("shard").agg(F.sum("n").alias("_n")).select("shard", F.coalesce(F.sum("_n").over(before()), F.lit(0)).alias("_first"))
    inner = sizes.select("shard", "segment", F.coalesce(F.sum("n").over(before("shard")), F.lit(0)).alias("_inner"))
    first = inner.join(whole, "shard").select("shard", "segment", (F.col("_first") + F.col("_inner")).alias("_first"))
    found = shards.mapInArrow(_digests, "shard long, segment long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(first, ["shard", "segment"]).select(
        "doc_id", (F.col("_first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def find_token(spark: SparkSession, folder: str, symbol: int) -> DataFrame:
    """(doc_id, position) of every occurrence of an id, found by rank and select."""
    return read_shards(spark, folder).mapInArrow(_occurrences(symbol), "doc_id long, position long")
