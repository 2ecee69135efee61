"""Quality classifier: a generalised additive model with pairwise interactions.

Every whole text becomes a short row of counts and shares. Each feature has a lookup
table over quantile bins and each chosen pair of features one over bin pairs. The
tables are sums of shallow trees: boosting cycles over the features, fits a tree of
at most ``LEAVES`` leaves on one feature's bin histogram to the logistic residuals and
adds it to that feature's table; then the pairs that explain most of what is left are
boosted the same way, one split on each side. A score adds one table entry per bin.

The model is fitted on at most ``rows`` labelled rows, taken in hash order of doc_id;
scoring reads every whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import texts
from netsleuth.llm.toxicity import learnable

ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
LEAVES = 4

FEATURES = ["words", "bytes_per_word", "long_words", "short_words", "distinct", "top_word", "stutter", "alternate",
            "repeated_three", "upper", "digits", "points", "symbols", "exclaims", "pipes", "high_bytes", "controls",
            "lines", "repeated_lines", "words_per_line", "marked_ends"]


def _byte_classes():
    import numpy as np

    table = np.zeros((256, 9))
    for column, members in enumerate([
            range(65, 91), range(48, 58), b".,;:'\"()-?", b"#$%&*+/<=>@[\\]^_`{}~", b"!", b"|", range(128, 256),
            [*range(0, 9), *range(14, 32), 127], b"\n"]):
        table[list(members), column] = 1
    return table


def text_features(words, row, data, classes):
    """The feature row of one text of a Words chunk; ``data`` are its bytes."""
    import numpy as np

    from netsleuth.llm.words import windows

    a, b = words.first[row], words.first[row + 1]
    n, size = b - a, max(1, len(data))
    shares = np.bincount(data, minlength=256) @ classes / size
    lines = data.tobytes().split(b"\n")
    filled = [x for x in lines if x.strip()]
    out = np.zeros(len(FEATURES))
    out[0] = np.log1p(n)
    if n:
        h, length = words.hash[a:b], words.length[a:b]
        distinct, counts = np.unique(h, return_counts=True)
        out[1], out[2], out[3] = length.mean(), (length >= 14).mean(), (length <= 3).mean()
        out[4], out[5] = len(distinct) / n, counts.max() / n
        if n > 2:
            out[6], out[7] = (h[1:] == h[:-1]).mean(), (h[2:] == h[:-2]).mean()
            three = windows(h, 3)
            out[8] = 1 - len(np.unique(three)) / len(three)
        last = words.data[words.end[a:b] - 1]
        out[20] = ((last >= 33) & (last < 48) & (last != 44) & (last != 46) | (last > 90) & (last < 97) | (last > 122) & (last < 128)).mean()
    out[9:17] = shares[:8]
    out[17], out[18] = np.log1p(len(filled)), 1 - len(set(filled)) / max(1, len(filled))
    out[19] = np.log1p(n / max(1, len(filled)))
    return out


def _matrix(batch):
    """(first row, last row, features) over chunks of a batch."""
    import numpy as np

    from netsleuth.llm.words import Words, chunks, string_offsets

    classes = _byte_classes()
    offsets, data = string_offsets(batch.column("text"))
    for a, b in chunks(offsets):
        words = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        yield a, b, np.stack([text_features(words, r, data[offsets[a + r]:offsets[a + r + 1]], classes) for r in range(b - a)])


class AdditiveModel:
    """Lookup tables over binned features and pairs of them."""

    def __init__(self, x, y, rounds: int = 120, pair_rounds: int = 40, rate: float = 0.15):
        import numpy as np

        grid = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, f], grid)) for f in range(x.shape[1])]
        coarse = np.linspace(0, 1, PAIR_BINS + 1)[1:-1]
        self.pair_cuts = [np.unique(np.quantile(x[:, f], coarse)) for f in range(x.shape[1])]
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        self.constant = float(np.log(share / (1 - share)))
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs, self.pair_tables = [], []
        bins, z = self._bins(x, self.cuts), np.full(len(y), self.constant)
        for _ in range(rounds):
            for f, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-z))
                step = self._tree(bins[f], y - p, p * (1 - p), len(table)) * rate
                table += step
                z += step[bins[f]]
        bins = self._bins(x, self.pair_cuts)
        p = 1 / (1 + np.exp(-z))
        gains = [(self._pair(bins, i, j, y - p, p * (1 - p))[0], i, j) for i in range(len(bins)) for j in range(i)]
        self.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
        self.pair_tables = [np.zeros((len(self.pair_cuts[i]) + 1, len(self.pair_cuts[j]) + 1)) for i, j in self.pairs]
        for _ in range(pair_rounds):
            for (i, j), table in zip(self.pairs, self.pair_tables):
                p = 1 / (1 + np.exp(-z))
                step = self._pair(bins, i, j, y - p, p * (1 - p))[1] * rate
                table += step
                z += step[bins[i], bins[j]]

    @staticmethod
    def _bins(x, cuts):
        import numpy as np

        return [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]

    @staticmethod
    def _tree(bins, residual, weight, size, ridge: float = 1.0):
        """Leaf values per bin of a tree grown best-first on one feature."""
        import numpy as np

        g = np.concatenate([[0], np.cumsum(np.bincount(bins, weights=residual, minlength=size))])
        h = np.concatenate([[0], np.cumsum(np.bincount(bins, weights=weight, minlength=size))])
        value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
        leaves = [(0, size)]
        while len(leaves) < LEAVES:
            best = (1e-9, None, None)
            for leaf in leaves:
                a, b = leaf
                if b - a < 2:
                    continue
                at = np.arange(a + 1, b)
                gain = value(a, at) + value(at, b) - value(a, b)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], leaf, int(at[k]))
            if best[1] is None:
                break
            a, b = best[1]
            leaves.remove(best[1])
            leaves += [(a, best[2]), (best[2], b)]
        out = np.zeros(size)
        for a, b in leaves:
            out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
        return out

    def _pair(self, bins, i, j, residual, weight, ridge: float = 1.0):
        """(gain, table) of the best tree with one split on either feature."""
        import numpy as np

        shape = (len(self.pair_cuts[i]) + 1, len(self.pair_cuts[j]) + 1)
        at = bins[i] * shape[1] + bins[j]
        total = lambda w: np.bincount(at, weights=w, minlength=shape[0] * shape[1]).reshape(shape)
        g, h = (np.pad(total(w).cumsum(0).cumsum(1), ((1, 0), (1, 0))) for w in (residual, weight))
        if min(shape) < 2:
            return 0.0, np.zeros(shape)
        corners = lambda s: (s[1:-1, 1:-1], s[1:-1, -1:] - s[1:-1, 1:-1], s[-1:, 1:-1] - s[1:-1, 1:-1],
                             s[-1, -1] - s[1:-1, -1:] - s[-1:, 1:-1] + s[1:-1, 1:-1])
        parts = list(zip(corners(g), corners(h)))
        gain = sum(a ** 2 / (b + ridge) for a, b in parts) - g[-1, -1] ** 2 / (h[-1, -1] + ridge)
        r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
        low, high = np.arange(shape[0])[:, None] <= r, np.arange(shape[1])[None, :] <= c
        leaf = [np.broadcast_to(a / (b + ridge), gain.shape)[r, c] for a, b in parts]
        table = np.where(low, np.where(high, leaf[0], leaf[1]), np.where(high, leaf[2], leaf[3]))
        return float(gain[r, c]), table

    def score(self, x):
        import numpy as np

        z = np.full(len(x), self.constant)
        for table, bins in zip(self.tables, self._bins(x, self.cuts)):
            z += table[bins]
        bins = self._bins(x, self.pair_cuts)
        for (i, j), table in zip(self.pairs, self.pair_tables):
            z += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _features(batches):
    import pyarrow as pa

    for batch in batches:
        for a, b, x in _matrix(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column("y").slice(a, b - a), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(
                    pa.list_(pa.float64()))], names=["y", "x"])


def _scores(shipped):
    def run(batches):
        import pyarrow as pa

        model = shipped.value
        for batch in batches:
            for a, b, x in _matrix(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(model.score(x))], names=["doc_id", "score"])

    return run


def score_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS) -> DataFrame:
    """(doc_id, score) of every document; ``score`` in 0..1 is higher where label 1 is likelier.

    Learns from rows that :func:`learnable` admits and whose label is 0 or 1; of repeated
    label rows the largest holds. Without labels every score is the share of label 1
    (0.5 if there are none). A null or empty text is scored by its zero features. Rows
    without doc_id are left out; repeated rows score alike; other columns are ignored.
    """
    import numpy as np

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(rows)
    docs = texts(documents)
    # at most ``rows`` short rows reach the driver
    fitted = docs.join(F.broadcast(chosen), "doc_id").select("y", "text").mapInArrow(_features, "y int, x array<double>").toArrow()
    y = fitted.column("y").to_numpy().astype(float)
    x = (np.array(fitted.column("x").combine_chunks().flatten()).reshape(len(y), -1) if len(y)
         else np.zeros((1, len(FEATURES))))
    model = AdditiveModel(x, y if len(y) else np.array([0.5]))
    return docs.mapInArrow(_scores(documents.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")
