"""Postings packed by part: all terms of a few megabytes of texts as one compressed row.

The texts of a part have their ids, terms and counts in arrays, a term as its number among the part's terms. So what
travels by term is a row for each term of a part, not for each term of a text, and what is stored takes a few bytes a
posting. Frames of postings or weights are views of the packed rows and carry them along for the operators that
read them part by part; a frame of other origin is packed first. All rows of an id lie in one part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.session import durable, durable_partitions, ship, shuffle_width

#: Rows of a frame without packed parts that make up a part.
PART_ROWS = 500_000
#: Rows that a view hands over at once.
VIEW_ROWS = 100_000


@dataclass
class Packed:
    """``parts`` (part, data) has one row and one partition for each of ``n`` parts; ``kind`` is the SQL type of ids.

    ``frequency`` is (term, df), ``texts`` the number of ids with a term and ``length`` the sum of their lengths; packed
    weights have none of the three.
    """

    parts: DataFrame
    n: int
    kind: str
    frequency: DataFrame | None = None
    texts: int = 0
    length: int = 0

    def part_of(self, key: str) -> Column:
        return part_of(F.col(key).cast(self.kind), self.n)


def part_of(key: Column, n: int) -> Column:
    return F.pmod(F.hash(key), F.lit(n)).cast("int")


def carry(df: DataFrame, packed: Packed) -> DataFrame:
    df._packed = packed
    return df


def carried(df: DataFrame) -> Packed | None:
    return df.__dict__.get("_packed")


class Part:
    """A part read back: ``ids``, ``terms`` (Arrow), ``first`` posting of each id, and by posting ``at`` (its term), then
    ``tf`` and ``length``, with ``df`` of the terms; or ``w``, and maybe ``band`` of the ids."""

    def __init__(self, data, texts: int = 0):
        import pyarrow as pa

        batch = pa.ipc.open_stream(data).read_next_batch()
        held = {name: batch.column(name)[0].values for name in batch.schema.names}
        self.ids, self.terms = held.pop("ids"), held.pop("terms")
        for name in ("first", "at", "tf", "length", "df", "w", "band"):
            setattr(self, name, held[name].to_numpy() if name in held else None)
        self.counted = texts

    def sizes(self):
        import numpy as np

        return np.diff(self.first)

    def text(self):
        """The number of its id for each posting."""
        import numpy as np

        return np.repeat(np.arange(len(self.ids)), self.sizes())

    def weights(self):
        """The unit-length weight of each posting and the band of each id: its norm in half octaves."""
        import numpy as np

        if self.w is not None:
            return self.w, self.band
        tf = self.tf.astype("float64")
        raw = tf * np.log((self.counted + 1.0) / (self.df + 1.0))[self.at] + tf
        norm = np.sqrt(np.add.reduceat(raw * raw, self.first[:-1]))
        return raw / np.repeat(norm, self.sizes()), np.floor(2 * np.log2(norm)).astype(np.int32)


def dumped(**columns) -> bytes:
    import pyarrow as pa

    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v))
             for v in columns.values()]
    batch = pa.RecordBatch.from_arrays(lists, list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _row(part: int, data: bytes):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data], pa.binary())], ["part", "data"])


def _joined(dictionaries: list, codes: list):
    """One dictionary of several with the codes under it."""
    import numpy as np
    import pyarrow as pa

    enc = pa.concat_arrays(dictionaries).dictionary_encode("encode")
    to = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    shift = np.cumsum([0, *[len(d) for d in dictionaries]])
    return enc.dictionary, np.concatenate([to[c + s] for c, s in zip(codes, shift)])


def _pack_texts(batches):
    """Kernel: the words of a partition's texts (part, id, words), counted by text and packed."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    part, ids, lengths, texts, codes, tfs, dictionaries, n = None, [], [], [], [], [], [], 0
    for batch in batches:
        words = batch.column("words")
        size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        has = np.flatnonzero(size)
        if not len(has):
            continue
        part = batch.column("part")[0].as_py()
        coded = words.flatten().dictionary_encode()
        of = np.repeat(np.arange(len(has)), size[has])
        key, tf = np.unique(of * len(coded.dictionary) + coded.indices.to_numpy(), return_counts=True)
        texts.append(n + key // len(coded.dictionary))
        codes.append(key % len(coded.dictionary))
        tfs.append(tf)
        dictionaries.append(coded.dictionary)
        ids.append(batch.column("id").take(pa.array(has)))
        lengths.append(size[has])
        n += len(has)
    if part is None:
        return
    terms, at = _joined(dictionaries, codes)
    text, tf, length = np.concatenate(texts), np.concatenate(tfs), np.concatenate(lengths)
    named = pa.concat_arrays(ids).dictionary_encode("encode")
    whose = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # rows of one id and length are one text
    wide = int(length.max()) + 1
    kinds, same = np.unique(whose * wide + length, return_inverse=True)
    key, where = np.unique(same[text] * len(terms) + at, return_inverse=True)
    tf = np.bincount(where, tf, len(key)).astype(np.int64)
    text, at = key // len(terms), key % len(terms)
    of = (kinds // wide)[text]
    yield _row(part, dumped(
        ids=named.dictionary, terms=terms, first=np.searchsorted(of, np.arange(len(named.dictionary) + 1)).astype(np.int32),
        at=at.astype(np.int32), tf=tf, length=(kinds % wide)[text].astype(np.int32)))


def _pack_rows(batches):
    """Kernel: a partition's weights (part, id, term, weight), packed."""
    import numpy as np
    import pyarrow as pa

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    one = lambda c: whole.column(c).combine_chunks()
    ids, terms = one("id").dictionary_encode("encode"), one("term").dictionary_encode()
    of = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(of, kind="stable")
    first = np.searchsorted(of[order], np.arange(len(ids.dictionary) + 1)).astype(np.int32)
    more = {"band": one("band").to_numpy()[order][first[:-1]]} if "band" in whole.column_names else {}
    yield _row(whole.column("part")[0].as_py(), dumped(
        ids=ids.dictionary, terms=terms.dictionary, first=first, at=terms.indices.to_numpy()[order].astype(np.int32),
        w=one("weight").to_numpy()[order], **more))


def parts_of(data, texts: int = 0):
    """The parts of a kernel's batches of packed rows, each with its number."""
    for batch in data:
        for i in range(batch.num_rows):
            yield batch.column("part")[i].as_py(), Part(batch.column("data")[i].as_buffer(), texts)


def by_part(packed: Packed, rows: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """``kernel(part, table)`` of every part and the ``rows`` (part, ...) sent to it, as many tasks as parts."""
    texts = packed.texts

    def run(left, right):
        import pyarrow as pa

        if not (left.num_rows and right.num_rows):
            return pa.table({})
        return kernel(Part(left.column("data")[0].as_buffer(), texts), right.combine_chunks())

    return packed.parts.repartition(packed.n, "part").groupBy("part").cogroup(
        rows.repartition(packed.n, "part").groupBy("part")).applyInArrow(run, schema)


def over_parts(packed: Packed, kernel: Callable, schema: str) -> DataFrame:
    """The record batches that ``kernel(number, part)`` yields for every part."""
    texts = packed.texts

    def run(batches):
        for number, part in parts_of(batches, texts):
            yield from kernel(number, part)

    return packed.parts.mapInArrow(run, schema)


def sliced(columns: dict):
    """Record batches of ``VIEW_ROWS`` rows of Arrow or numpy columns."""
    import pyarrow as pa

    table = pa.table(columns)
    yield from table.to_batches(max_chunksize=VIEW_ROWS)


def _part_terms(number, part):
    import numpy as np

    yield from sliced({"part": np.full(len(part.terms), number, np.int32), "no": np.arange(len(part.terms), dtype=np.int32),
                       "term": part.terms, "n": np.bincount(part.at, minlength=len(part.terms))})


def _part_sizes(number, part):
    import numpy as np

    longest = np.maximum.reduceat(part.length, part.first[:-1])
    yield from sliced({"n": np.array([len(part.ids)]), "length": np.array([longest.sum()], dtype=np.int64)})


def _with_frequency(part, told):
    import numpy as np
    import pyarrow as pa

    df = np.zeros(len(part.terms), dtype=np.int64)
    df[told.column("no").to_numpy()] = told.column("df").to_numpy()
    data = dumped(ids=part.ids, terms=part.terms, first=part.first, at=part.at, tf=part.tf, length=part.length, df=df)
    return pa.table({"part": told.column("part").slice(0, 1).cast(pa.int32()), "data": pa.array([data], pa.binary())})


def terms_of(packed: Packed) -> DataFrame:
    """(part, no, term, n): each part's terms with their numbers and how many postings there have them."""
    return over_parts(packed, _part_terms, "part int, no int, term string, n long")


def pack_texts(words: DataFrame, n: int, kind: str) -> Packed:
    """Texts (id, words) that lie in ``n`` partitions by id, packed with the frequencies of their terms."""
    ship(words.sparkSession)
    parts = durable_partitions(words.select(part_of(F.col("id"), n).alias("part"), "id", "words").mapInArrow(
        _pack_texts, "part int, data binary"), adaptive=True)
    bare = Packed(parts, n, kind)
    terms = terms_of(bare)
    frequency = durable(terms.groupBy("term").agg(F.sum("n").alias("df")), "zstd")
    told = terms.select("part", "no", "term").join(frequency, "term").select("part", "no", "df")
    parts = durable_partitions(by_part(bare, told, _with_frequency, "part int, data binary"), adaptive=True)
    sums = over_parts(bare, _part_sizes, "n long, length long").agg(F.sum("n"), F.sum("length")).first()
    return Packed(parts, n, kind, frequency, sums[0] or 0, sums[1] or 0)


def pack_weights(weights: DataFrame) -> Packed:
    """The packed parts that a frame of weights (id, term, weight) carries, or those of its rows."""
    packed = carried(weights)
    if packed is not None:
        return packed
    spark = weights.sparkSession
    ship(spark)
    more = [F.col("band").cast("int").alias("band")] if "band" in weights.columns else []
    rows = weights.filter("term is not null and weight is not null").select(
        "id", "term", F.col("weight").cast("double").alias("weight"), *more)
    n = max(shuffle_width(spark), -(-rows.count() // PART_ROWS))
    placed = rows.repartition(n, "id").select(part_of(F.col("id"), n).alias("part"), *rows.columns)
    return Packed(durable_partitions(placed.mapInArrow(_pack_rows, "part int, data binary"), adaptive=True), n,
                  weights.schema["id"].dataType.simpleString())


def _postings(number, part):
    import numpy as np
    import pyarrow as pa

    yield from sliced({"id": part.ids.take(pa.array(part.text())), "length": part.length, "term": part.terms.take(pa.array(part.at)),
                       "tf": part.tf.astype(np.int64)})


def postings_view(packed: Packed) -> DataFrame:
    """(id, length, term, tf) of every part."""
    return carry(over_parts(packed, _postings, f"id {packed.kind}, length int, term string, tf long"), packed)


def postings_of(packed: Packed, ids: DataFrame) -> DataFrame:
    """The rows of :func:`postings_view` whose id is among ``ids`` (id), which have no nulls."""
    def pick(part, asked):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        wanted = pc.is_in(part.ids, value_set=asked.column("id").combine_chunks().cast(part.ids.type), skip_nulls=True).to_numpy(zero_copy_only=False)
        text = part.text()
        at = np.flatnonzero(wanted[text])
        return pa.table({"id": part.ids.take(pa.array(text[at])), "length": part.length[at],
                         "term": part.terms.take(pa.array(part.at[at])), "tf": part.tf[at].astype(np.int64)})

    asked = ids.filter("id is not null").select(F.col("id").cast(packed.kind).alias("id")).distinct()
    return by_part(packed, asked.select(packed.part_of("id").alias("part"), "id"), pick,
                   f"id {packed.kind}, length int, term string, tf long")


def weights_view(packed: Packed, terms=None) -> DataFrame:
    """(id, term, weight, band) of every part, or of the ``terms`` of an Arrow array alone."""
    def rows(number, part):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        w, band = part.weights()
        text = part.text()
        at = np.arange(len(w)) if terms is None else np.flatnonzero(
            pc.is_in(part.terms, value_set=terms).to_numpy(zero_copy_only=False)[part.at])
        yield from sliced({"id": part.ids.take(pa.array(text[at])), "term": part.terms.take(pa.array(part.at[at])),
                           "weight": w[at], "band": pa.nulls(len(at), pa.int32()) if band is None else band[text[at]]})

    return carry(over_parts(packed, rows, f"id {packed.kind}, term string, weight double, band int"), packed)
