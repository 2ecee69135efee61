"""Toxicity by class-conditional Kneser-Ney bigram models.

A toxic and an ordinary model give every text a log-likelihood per word each. Counts
are continuation counts, so copies of a text add nothing: of a word the contexts it
follows in the class, of a bigram the words before it. Up to ``RARE_WORD`` and
``RARE_BIGRAM`` of each count are discounted and handed to the next level; the last is
one distribution built from the discounted (backoff) counts of both classes together.
So an expression rare in both classes weighs the same in both models, and the tables
need to hold only those that one class repeats. A word whose likelihoods differ by
less than a factor exp(``MARGIN``) is taken as equally likely. What is left becomes a
probability by a logistic curve fitted on labelled rows outside the counts.

The models are fitted on at most ``class_rows`` labelled rows of each class and
``curve_rows`` further ones, taken in hash order of doc_id; these bounds keep the
tables at a fixed size. Scoring reads every whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import texts, written

CLASS_ROWS = 3000
CURVE_ROWS = 4000
RARE_WORD = 2
RARE_BIGRAM = 30
MARGIN = 1.5
START = 0x51ED270B9F86D1C3


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def label_sample(documents: DataFrame, labels: DataFrame, label: str, class_rows: int, curve_rows: int) -> DataFrame:
    """(doc_id, text, y, part): rows of both classes for counts (part 0) and of the natural mix for the curve (part 1).

    Three ids in ten are set aside for the curve, by hash. Rows with a null label or id
    are left out; of repeated label rows the largest value holds.
    """
    spare = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(10)) < 3
    order = F.xxhash64("doc_id", F.lit(7))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.filter(~spare).groupBy("y").count().collect()}
    # as many of either class, so that neither model knows more rare words
    rows = min(class_rows, sizes.get(0, 0), sizes.get(1, 0))
    counts = [known.filter(~spare & (F.col("y") == y)).orderBy(order, "doc_id").limit(rows) for y in (0, 1)]
    curve = known.filter(spare).orderBy(order, "doc_id").limit(curve_rows)
    chosen = counts[0].unionByName(counts[1]).withColumn("part", F.lit(0)).unionByName(curve.withColumn("part", F.lit(1)))
    # at most 2 * class_rows + curve_rows rows
    return texts(documents).join(F.broadcast(chosen), "doc_id")


def _bigrams(words):
    """(context, word) hashes of every word of a chunk; a text's first word follows a start mark."""
    import numpy as np

    context = np.empty_like(words.hash)
    context[1:] = words.hash[:-1]
    context[words.first[:-1][words.counts > 0]] = START
    return context, words.hash


def _trigrams(batches):
    """Kernel: distinct (word before, context, word, class) of a batch."""
    import numpy as np
    import pyarrow as pa

    from netsleuth.llm.words import signed, word_chunks

    for batch in batches:
        label = batch.column("y").to_numpy(zero_copy_only=False)
        for a, b, words in word_chunks(batch.column("text"), lower=True):
            context, word = _bigrams(words)
            before = np.concatenate([[np.uint64(START)], context[:-1]]) if len(context) else context
            y = label[a + words.row_of_word()].astype(np.uint64)
            rows = np.unique(np.stack([before, context, word, y], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(rows[:, i])) for i in range(3)] + [pa.array(rows[:, 3].astype(np.int32))],
                names=["before", "context", "word", "y"])


def fit_models(sample: DataFrame) -> "Models":
    """Both models from (text, y) rows; the tables are counted in Spark and only repeated expressions collected."""
    import numpy as np

    of = lambda y: F.sum((F.col("y") == y).cast("long")).alias(f"n{y}")
    bigrams = written(sample.mapInArrow(_trigrams, "before long, context long, word long, y int").distinct().groupBy(
        "context", "word").agg(of(0), of(1)), "bigrams")
    kinds = lambda y: F.sum((F.col(f"n{y}") > 0).cast("long")).alias(f"s{y}")
    spread = written(bigrams.groupBy("word").agg(kinds(0), kinds(1)), "words")
    low = lambda c, bound: F.least(F.col(c), F.lit(bound))
    total = spread.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (
        F.col("s0"), F.col("s1"), low("s0", RARE_WORD), low("s1", RARE_WORD))], F.count(F.lit(1))).first()
    words = spread.filter(F.greatest("s0", "s1") > RARE_WORD).toArrow()
    repeated = bigrams.filter(F.greatest("n0", "n1") > RARE_BIGRAM)
    contexts = bigrams.join(repeated.select("context").distinct(), "context").groupBy("context").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum(low("n0", RARE_BIGRAM)).alias("l0"),
        F.sum(low("n1", RARE_BIGRAM)).alias("l1")).toArrow()
    repeated = repeated.toArrow()
    column = lambda table, name: table.column(name).to_numpy()
    hashes = lambda table, name: np.ascontiguousarray(column(table, name)).view(np.uint64)
    return Models(total, (hashes(words, "word"), column(words, "s0"), column(words, "s1")),
                  (hashes(contexts, "context"), *[column(contexts, c) for c in ("n0", "n1", "l0", "l1")]),
                  (hashes(repeated, "context"), hashes(repeated, "word"), column(repeated, "n0"), column(repeated, "n1")))


class Models:
    """Tables of both models, ready for lookups by hash."""

    def __init__(self, total, words, contexts, bigrams):
        import numpy as np

        from netsleuth.llm.words import pair

        order = np.argsort(words[0])
        self.vocabulary = words[0][order]
        spread = [w[order] for w in words[1:]]
        pooled = sum(np.minimum(s, RARE_WORD) for s in spread)
        whole = total[2] + total[3] + total[4] + 1
        base, unseen = (pooled + 1) / whole, 1 / whole
        by_context = np.argsort(contexts[0])
        self.contexts = contexts[0][by_context]
        keys = pair(bigrams[0], bigrams[1])
        by_key = np.argsort(keys)
        self.keys = keys[by_key]
        at, known = self._find(self.contexts, bigrams[0])
        self.word, self.context, self.bigram, self.unseen = [], [], [], []
        for c in (0, 1):
            kinds = max(1, total[c])
            left = total[2 + c] / kinds if total[c] else 1.0
            self.word.append(np.maximum(spread[c] - RARE_WORD, 0) / kinds + left * base)
            self.unseen.append(left * unseen)
            seen, low = contexts[1 + c][by_context], contexts[3 + c][by_context]
            self.context.append(np.where(seen > 0, low / np.maximum(seen, 1), 1.0))
            follows = np.maximum(seen[at], 1) if len(seen) else np.ones(len(at))
            self.bigram.append((np.maximum(bigrams[2 + c] - RARE_BIGRAM, 0) / follows)[by_key])

    @staticmethod
    def _find(table, keys):
        import numpy as np

        if not len(table):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def per_word(self, words):
        """(ordinary, toxic, marked): mean log-likelihoods per word of each text, and the mean of what exceeds the margin."""
        import numpy as np

        from netsleuth.llm.words import pair

        context, word = _bigrams(words)
        at_word, has_word = self._find(self.vocabulary, word)
        at_context, has_context = self._find(self.contexts, context)
        row, n = words.row_of_word(), len(words.counts)
        mean = lambda v: np.bincount(row, weights=v, minlength=n) / np.maximum(words.counts, 1)
        # only contexts with a repeated bigram hold one
        inner = np.flatnonzero(has_context)
        at_pair, has_pair = self._find(self.keys, pair(context[inner], word[inner]))
        logs = []
        for c in (0, 1):
            p = np.where(has_word, self.word[c][at_word], self.unseen[c]) if len(self.vocabulary) else np.full(len(word), self.unseen[c])
            if len(inner):
                own = np.where(has_pair, self.bigram[c][at_pair], 0.0) if len(self.keys) else 0.0
                p[inner] = own + self.context[c][at_context[inner]] * p[inner]
            logs.append(np.log(p))
        apart = logs[1] - logs[0]
        marked = np.maximum(apart - MARGIN, 0) + np.minimum(apart + MARGIN, 0)
        return mean(logs[0]), mean(logs[1]), mean(marked)


def _features(marked, counts):
    import numpy as np

    return np.stack([np.ones(len(counts)), np.sqrt(np.maximum(marked, 0)), np.sqrt(np.maximum(-marked, 0)),
                     1 / np.sqrt(np.maximum(counts, 1.0))], axis=1)


def logistic_curve(x, y, ridge: float = 0.01, steps: int = 60):
    """Coefficients by Newton steps with a ridge on all but the constant."""
    import numpy as np

    scale = np.maximum(np.abs(x).max(axis=0), 1e-9) if len(x) else np.ones(x.shape[1])
    x = x / scale
    beta, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - penalty @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta / scale


def _likelihoods(shipped):
    """Kernel: the values of every whole text; keeps the other columns."""

    def run(batches):
        import pyarrow as pa

        from netsleuth.llm.words import word_chunks

        models = shipped.value
        for batch in batches:
            rest = [name for name in batch.schema.names if name != "text"]
            for a, b, words in word_chunks(batch.column("text"), lower=True):
                values = models.per_word(words)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(name).slice(a, b - a) for name in rest], pa.array(words.counts.astype("int64")),
                     *[pa.array(v) for v in values]], names=[*rest, "n_words", "ll_ordinary", "ll_toxic", "marked"])

    return run


def score_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic",
                   class_rows: int = CLASS_ROWS, curve_rows: int = CURVE_ROWS) -> DataFrame:
    """(doc_id, cls, n_words, ll_ordinary, ll_toxic, marked, score) of every document.

    ``score`` in 0..1 is higher for texts that look toxic; the log-likelihoods are means
    per word, ``cls`` hashes the text. Words are lower-cased in A-Z. A null or empty text
    has likelihoods 0 and the curve's value there. Without labels
    of both classes every score is the share of the known ones (0 if none). Repeated
    rows score alike; rows without doc_id are left out; other columns are ignored.
    """
    import numpy as np

    spark = documents.sparkSession
    sample = label_sample(documents, labels, label, class_rows, curve_rows)
    models = fit_models(sample.filter("part = 0").select("text", "y"))
    shipped = spark.sparkContext.broadcast(models)
    values = "n_words long, ll_ordinary double, ll_toxic double, marked double"
    fitted = sample.filter("part = 1").select("y", "text").mapInArrow(_likelihoods(shipped), "y int, " + values).toPandas()
    y = fitted["y"].to_numpy(dtype=float)
    x = _features(fitted["marked"].to_numpy(), fitted["n_words"].to_numpy())
    if len(y) and 0 < y.sum() < len(y):
        curve = logistic_curve(x, y)
    else:
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        curve = np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0])
    docs = texts(documents).withColumn("cls", F.xxhash64("text"))
    scored = docs.mapInArrow(_likelihoods(shipped), "doc_id long, cls long, " + values)
    z = (F.lit(float(curve[0])) + F.sqrt(F.greatest("marked", F.lit(0.0))) * float(curve[1])
         + F.sqrt(F.greatest(-F.col("marked"), F.lit(0.0))) * float(curve[2])
         + float(curve[3]) / F.sqrt(F.greatest("n_words", F.lit(1))))
    return scored.withColumn("score", 1 / (1 + F.exp(-z)))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that score below ``threshold``; rows without doc_id stay."""
    bad = score_toxicity(documents, labels).filter(F.col("score") >= threshold).select(
        F.col("doc_id").alias("__llm_id"), F.col("cls").alias("__llm_cls")).distinct()
    same = (documents["doc_id"].cast("long") == F.col("__llm_id")) & (F.xxhash64(documents["text"]) == F.col("__llm_cls"))
    return documents.join(bad, same, "left_anti")
