"""Dense vectors of texts: a randomised range finder over the sparse weights.

With X the (text x term) matrix of unit-length weights: random signs, hashed from the
term, mix its columns into ``dim`` ones (Y = X S); each power pass replaces Y by
X (X' Y), which turns it towards the leading directions; a ``dim`` x ``dim`` Gram matrix
makes its columns orthonormal (Q = Y M). B = Q' X = M' (X' Y)' and its Gram matrix then give the leading
singular directions, so that X is close to (Q U s) V'. A text's vector is its row of
Q U s, a question's its weights on V. X lies in packed parts by text (``packed``): a product with X' is summed in
each part first, one with X takes a row for each term of a part, so no row of ``dim`` numbers travels for a posting.
Only Gram matrices reach the driver, and no term or text is gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.operators.packed import by_part, over_parts, pack_weights, sliced, terms_of
from netsleuth.session import durable

DIM, POWER, SEED = 32, 1, 11
#: Directions whose singular value is this share of the largest carry no more than rounding.
FLAT = 1e-9


def _names(dim: int) -> list[str]:
    return [f"y{j}" for j in range(dim)]


def _by(rows: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Sums of weight times each column, by text or by term; combined map-side."""
    return rows.groupBy(key).agg(*[F.sum(F.col("weight") * F.col(n)).alias(n) for n in names])


def _signs(hashes, dim: int):
    """Kernel: fair signs (term x ``dim``), 64 columns from each hash of a term."""
    import numpy as np

    return np.column_stack([2.0 * ((hashes[j // 64] >> (j % 64)) & 1) - 1.0 for j in range(dim)])


def _products(names: list[str], signs: bool, with_texts: bool):
    """Kernel: with Z the rows sent for the terms of a part's X, the rows of X' (X Z) and, if asked for, those of X Z."""

    def run(part, told):
        import numpy as np
        import pyarrow as pa

        order = np.argsort(told.column("no").to_numpy())
        cells = [told.column(c).to_numpy()[order] for c in told.column_names if c not in ("part", "no")]
        z = _signs(cells, len(names)) if signs else np.column_stack(cells)
        w, _ = part.weights()
        text = part.text()
        y = [np.bincount(text, w * z[:, j][part.at], len(part.ids)) for j in range(len(names))]
        back = [np.bincount(part.at, w * column[text], len(part.terms)) for column in y]
        made = pa.table({"of_text": np.zeros(len(part.terms), dtype=bool), "id": pa.nulls(len(part.terms), part.ids.type), "term": part.terms,
                         **dict(zip(names, back))})
        if with_texts:
            texts = pa.table({"of_text": np.ones(len(part.ids), dtype=bool), "id": part.ids, "term": pa.nulls(len(part.ids), part.terms.type),
                              **dict(zip(names, y))})
            made = pa.concat_tables([made, texts])
        return made

    return run


def gram(rows: DataFrame, names: list[str]):
    """The matrix of products of all pairs of columns; each task adds up its own rows first."""
    import numpy as np

    def add(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((len(names), len(names)))
        for batch in batches:
            y = np.column_stack([batch.column(n).to_numpy() for n in names]) if batch.num_rows else np.zeros((0, len(names)))
            total += y.T @ y
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel())], ["cell", "v"])

    cells = rows.select(*names).mapInArrow(add, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(names) ** 2)
    for cell in cells:
        out[cell["cell"]] = cell["v"]
    return out.reshape(len(names), -1)


def _leading(matrix):
    """Eigenvalues and vectors of a Gram matrix, largest first, without the flat ones."""
    import numpy as np

    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = values > max(values[0] if len(values) else 0.0, 0.0) * FLAT
    return values[keep], vectors[:, keep]


def turned(rows: DataFrame, key: str, names: list[str], matrix) -> DataFrame:
    """(key, y0, ...): each row of columns times a small matrix."""
    out = _names(matrix.shape[1])
    kind = rows.schema[key].dataType.simpleString()

    def turn(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            y = np.column_stack([batch.column(n).to_numpy() for n in names]) @ matrix if batch.num_rows else np.zeros((0, len(out)))
            yield pa.RecordBatch.from_arrays([batch.column(key), *[pa.array(y[:, j]) for j in range(len(out))]], [key, *out])

    return rows.select(key, *names).mapInArrow(turn, ", ".join([f"{key} {kind}", *[f"{n} double" for n in out]]))


def _mass(number, part):
    w, _ = part.weights()
    yield from sliced({"mass": [float(w @ w)]})


@dataclass
class Embedding:
    """``texts`` is (id, vector) of unit length, ``terms`` (term, y0, ...) the directions, ``weights`` the input.

    ``basis`` holds (id, y0, ...) with orthonormal columns; ``captured`` is the share of
    the squared weights that the subspace keeps.
    """

    texts: DataFrame
    terms: DataFrame
    weights: DataFrame
    basis: DataFrame
    dim: int
    captured: float


def embed_text(weights: DataFrame, dim: int = DIM, power: int = POWER, seed: int = SEED) -> Embedding:
    """Vectors of at most ``dim`` dimensions for the texts of (id, term, weight) rows.

    Fewer dimensions come back where the texts span fewer. A text without terms has no row.
    """
    import numpy as np

    parts = pack_weights(weights)
    weights = weights.select("id", "term", "weight")
    names = _names(dim)
    terms = terms_of(parts).select("part", "no", "term")
    # X Z and X' (X Z) in one go, from a row for each term of a part
    told = terms.select("part", "no", *[F.xxhash64("term", F.lit(seed + i)).alias(f"h{i}") for i in range(-(-dim // 64))])
    shape = f"of_text boolean, id {parts.kind}, term string, " + ", ".join(f"{n} double" for n in names)
    for turn in range(power + 1):
        last = turn == power
        made = by_part(parts, told, _products(names, turn == 0, last), shape)
        if last:
            made = durable(made)
        sums = durable(made.filter("not of_text").groupBy("term").agg(*[F.sum(n).alias(n) for n in names]))
        if not last:
            told = terms.join(sums, "term").select("part", "no", *names)
    y = made.filter("of_text").select("id", *names)
    values, vectors = _leading(gram(y, names))
    if not len(values):  # no text has a term
        none = weights.limit(0)
        return Embedding(none.select("id", F.array().cast("array<double>").alias("vector")), none.select("term"), weights,
                         none.select("id"), 0, 0.0)
    upright = vectors / np.sqrt(values)
    basis = durable(turned(y, "id", names, upright))
    squares, turn = _leading(gram(turned(sums, "term", names, upright), _names(len(values))))
    terms = durable(turned(sums, "term", names, upright @ (turn / np.sqrt(squares))))
    placed = turned(basis, "id", _names(len(values)), turn * np.sqrt(squares))
    row = F.array(*_names(len(squares)))
    length = F.sqrt(F.aggregate(row, F.lit(0.0), lambda a, x: a + x * x))
    texts = durable(placed.select("id", F.transform(row, lambda x: x / F.when(length > 0, length).otherwise(1.0)).alias("vector")))
    whole = over_parts(parts, _mass, "mass double").agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0]
    return Embedding(texts, terms, weights, basis, len(squares), float(squares.sum() / whole) if whole else 0.0)


def embed_queries(queries: DataFrame, embedding: Embedding) -> DataFrame:
    """(q_id, vector) of the weighted terms (q_id, term, weight); terms without a direction add nothing."""
    if not embedding.dim:
        return queries.limit(0).select("q_id", F.array().cast("array<double>").alias("vector"))
    names = _names(embedding.dim)
    placed = _by(queries.join(embedding.terms, "term"), "q_id", names)
    return placed.select("q_id", F.array(*names).alias("vector"))
