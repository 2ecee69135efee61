"""Two-stage retrieval over text: weighted terms, top-k recall, BM25 rerank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsleuth.functions.columns import tokens
from netsleuth.operators import packed
from netsleuth.session import durable

TOP_K = 12
RERANK_N = 4
K1, B = 1.2, 0.75
SMALL_QUERY_TERMS = 200_000
QUERY_SALTS = 32
#: Texts that set the bar of a search, as a multiple of the hits wanted.
SEED_TEXTS = 4
#: Terms that together reach this share of the bar are left out of the first gathering. More of them gather
#: less and leave more texts to score in full.
REST_SHARE = 0.1
#: Scores are rounded to 6 places and summed in any order: what is this close to the bar counts as reaching it.
BAR_SLACK = 2e-6
#: Scores and products that a task holds at once; few enough for a cache, which halves the time.
BLOCK_CELLS = 1 << 17
#: Tasks for each core of a pass over the weights with one of several blocks of queries.
TASKS_A_CORE = 2
#: Text of a part, which a task cuts into words and holds with its counts. Larger parts share fewer terms with others.
PART_BYTES = 24_000_000


def build_postings(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Index rows (id, length, term, tf), stored once because every step reads them, packed by part.

    Texts move to their id's partition before they are cut into words: that is less
    data than the words, and no later step per text has to shuffle again. The parts are
    as many as the bytes of text call for, so that a task's counts stay in bounds however many texts there are.
    """
    size = texts.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    parts = max(texts.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    placed = texts.select(F.col(key).alias("id"), F.col(text).alias("_t")).repartition(parts, "id")
    words = placed.select("id", tokens(F.col("_t")).alias("words"))
    return packed.postings_view(packed.pack_texts(words, parts, texts.schema[key].dataType.simpleString()))


def document_frequency(postings: DataFrame) -> DataFrame:
    held = packed.carried(postings)
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")) if held is None else held.frequency


def _text_stats(postings: DataFrame) -> tuple:
    """Texts with a token, and their mean length."""
    held = packed.carried(postings)
    if held is None:
        stats = postings.groupBy("id").agg(F.max("length").alias("length")).agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avgdl"))).scalar()
        return stats["n"], stats["avgdl"]
    return F.lit(held.texts), F.lit(held.length / held.texts if held.texts else None).cast("double")


def tfidf_weights(postings: DataFrame) -> DataFrame:
    """Unit-length weights (id, term, weight): tf * ln((N+1)/(df+1)) + tf over the norm."""
    weights = banded_weights(postings)
    return packed.carry(weights.drop("band"), packed.carried(weights))


def banded_weights(postings: DataFrame) -> DataFrame:
    """The weights of :func:`tfidf_weights` with the ``band`` of their text: its norm in half octaves.

    Texts of a band are about equally long, so a term's largest weight in the band is
    close to its usual one there. ``postings`` are those of :func:`build_postings`, whose parts hold all that a text's
    weights need, so nothing is shuffled.
    """
    return packed.weights_view(packed.carried(postings))


def query_weights(questions: DataFrame, key: str, text: str, postings: DataFrame) -> DataFrame:
    """Question terms weighted by the corpus: (q_id, term, weight), unit length."""
    words = questions.select(F.col(key).alias("q_id"), F.explode(tokens(F.col(text))).alias("term"))
    counted = words.groupBy("q_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    with_df = counted.join(document_frequency(postings), "term", "left")
    n = _text_stats(postings)[0]
    tf = F.col("tf").cast("double")
    raw = with_df.withColumn("_w", tf * F.log((n + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + tf)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("q_id")))
    return raw.select("q_id", "term", (F.col("_w") / norm).alias("weight"))


def _matched(weights: DataFrame, asked: DataFrame, on: list[str]) -> DataFrame:
    """Weights that a query asks for, with the columns of ``asked``.

    A checked-small set of query terms is broadcast: the weights stay partitioned by
    text. A larger set is joined on (term, salt), the salt splitting common terms.
    """
    if asked.count() <= SMALL_QUERY_TERMS:
        return weights.join(F.broadcast(asked), on)
    salted = weights.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(QUERY_SALTS)).cast("int"))
    copies = asked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(QUERY_SALTS - 1))))
    return salted.join(copies, [*on, "_salt"]).drop("_salt")


def _best(scored: DataFrame, k: int, out: str) -> DataFrame:
    """The k best rows of each query by score, then id; parts of a query are cut to k rows first."""
    order = [F.desc("score"), F.col("id")]
    part = F.pmod(F.xxhash64("id"), F.lit(QUERY_SALTS))
    short = scored.withColumn("_part", part).withColumn(
        "_r", F.row_number().over(Window.partitionBy("q_id", "_part").orderBy(*order))).filter(F.col("_r") <= k).drop("_part", "_r")
    return short.withColumn(out, F.row_number().over(Window.partitionBy("q_id").orderBy(*order))).filter(F.col(out) <= k)


def _few(rows: DataFrame) -> bool:
    """Whether rows of query terms fit a broadcast."""
    return rows.count() <= SMALL_QUERY_TERMS


def _complete(pairs: DataFrame, weights: DataFrame, asked: DataFrame) -> DataFrame:
    """Full scores (q_id, id, score), not rounded, of distinct (q_id, id) pairs.

    Terms that fit a broadcast are summed in the parts of the weights, to which the pairs are sent.
    """
    if not _few(asked):
        held = weights.join(pairs.select("q_id", "id"), "id")
        return held.join(asked.select("q_id", "term", "wq"), ["q_id", "term"]).groupBy("q_id", "id").agg(
            F.sum(F.col("weight") * F.col("wq")).alias("score"))
    import numpy as np

    parts = packed.pack_weights(weights)
    terms, queries, first, query, wq = _by_term(asked.filter("q_id is not null and term is not null and wq is not null").toArrow())
    key = query * len(terms) + np.repeat(np.arange(len(terms)), np.diff(first))
    keys, where = np.unique(key, return_inverse=True)
    wq = np.bincount(where, wq, len(keys))

    def sums(part, told):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        number = lambda values, names: pc.fill_null(pc.index_in(values, value_set=names, skip_nulls=True), -1).to_numpy(
            zero_copy_only=False).astype(np.int64)
        w, _ = part.weights()
        of = number(part.terms, terms)[part.at]
        held = np.flatnonzero(of >= 0)
        of, w = of[held], w[held]
        starts = np.searchsorted(held, part.first)
        q, row = number(told.column("q_id").combine_chunks().cast(queries.type), queries), number(told.column("id").combine_chunks(), part.ids)
        good = np.flatnonzero((q >= 0) & (row >= 0))
        q, row = q[good], row[good]
        many = starts[row + 1] - starts[row]
        ends = np.concatenate([[0], np.cumsum(many)])
        score, met, a = np.zeros(len(q)), np.zeros(len(q), dtype=bool), 0
        while a < len(q) and len(keys):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + BLOCK_CELLS, side="right")) - 1)
            pair = np.repeat(np.arange(a, b), many[a:b])
            spot = np.arange(len(pair)) + np.repeat(starts[row[a:b]] - ends[a:b] + ends[a], many[a:b])
            asked_for = q[pair] * len(terms) + of[spot]
            at = np.minimum(np.searchsorted(keys, asked_for), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == asked_for)
            score += np.bincount(pair[hit], w[spot[hit]] * wq[at[hit]], len(q))
            met[pair[hit]] = True
            a = b
        found = good[met]
        return pa.table({"q_id": told.column("q_id").take(pa.array(found)), "id": told.column("id").take(pa.array(found)), "score": score[met]})

    sent = pairs.filter("q_id is not null and id is not null").select(
        parts.part_of("id").alias("part"), "q_id", F.col("id").cast(parts.kind).alias("id"))
    kind = pairs.schema["q_id"].dataType.simpleString()
    return packed.by_part(parts, sent, sums, f"q_id {kind}, id {parts.kind}, score double")


def term_reach(asked: DataFrame, weights: DataFrame) -> DataFrame:
    """Query terms in each band that has them: (q_id, term, band, wq, df, reach).

    ``reach`` is the most the term adds to the score of a text of the band, ``df`` the
    texts of the band that have it. There are a few dozen bands however many texts.
    """
    words = asked.select("term").filter("term is not null").distinct()
    terms = words.toArrow().column("term").combine_chunks() if _few(words) else None

    def tops(number, part):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        w, band = part.weights()
        if terms is None:
            held = np.arange(len(w))
        else:
            held = np.flatnonzero(pc.is_in(part.terms, value_set=terms).to_numpy(zero_copy_only=False)[part.at])
        if not len(held):
            return
        bands, at = np.unique(band, return_inverse=True)
        key = part.at[held].astype(np.int64) * len(bands) + at[part.text()[held]]
        order = np.argsort(key, kind="stable")
        cells, starts, df = np.unique(key[order], return_index=True, return_counts=True)
        yield from packed.sliced({"term": part.terms.take(pa.array(cells // len(bands))), "band": bands[cells % len(bands)],
                                  "_top": np.maximum.reduceat(w[held][order], starts), "df": df})

    found = packed.over_parts(packed.pack_weights(weights), tops, "term string, band int, _top double, df long")
    tops_of = found.groupBy("term", "band").agg(F.max("_top").alias("_top"), F.sum("df").alias("df"))
    return asked.join(tops_of, "term").select("q_id", "term", "band", "wq", "df", (F.col("wq") * F.col("_top")).alias("reach"))


def _reaching(weights: DataFrame, needed: DataFrame) -> DataFrame:
    """Pairs (q_id, id) whose score over the terms of ``needed`` plus the rest of their band gets to the bar.

    Terms that fit a broadcast are summed where the texts lie, so only the pairs that reach it leave a task.
    """
    if needed.count() > SMALL_QUERY_TERMS:
        gathered = _matched(weights, needed, ["term", "band"]).groupBy("q_id", "id").agg(
            F.sum(F.col("weight") * F.col("wq")).alias("_s"), F.first("bar").alias("bar"), F.first("rest").alias("rest"))
        return gathered.filter(F.col("_s") + F.col("rest") >= F.col("bar")).select("q_id", "id")
    import numpy as np
    import pyarrow as pa

    parts = packed.pack_weights(weights)
    held = needed.filter(F.col("wq").isNotNull()).toArrow()
    # the terms of a band are numbered for themselves: band * all terms + term
    words = held.column("term").combine_chunks().dictionary_encode("encode")
    bands, at = np.unique(held.column("band").to_numpy(), return_inverse=True)
    number = pa.array(at * max(1, len(words.dictionary)) + words.indices.to_numpy(zero_copy_only=False))
    places, queries, first, query, wq, order = _by_term(held.set_column(held.column_names.index("term"), "term", number), True)
    # what each query must still gather in each band: one value for all its terms there
    lack = np.full((len(bands) + 1, len(queries)), np.inf)
    lack[at[order], query] = (held.column("bar").to_numpy() - held.column("rest").to_numpy())[order]
    asked = words.dictionary, places.to_numpy(), queries, first, query, wq
    kind = needed.schema["q_id"].dataType.simpleString()
    return parts.parts.mapInArrow(_gathering(parts, asked, bands, lack), f"q_id {kind}, id {parts.kind}")


def _by_term(held, ordered: bool = False):
    """Query terms as numbers, from an Arrow table (q_id, term, wq or not).

    Gives (terms, queries, first, query, wq) as the kernels read them: the spans [first[t], first[t + 1]) of query numbers
    and weights for each term, and if ``ordered`` the rows of ``held`` in that order.
    """
    import numpy as np

    terms, names = (held.column(c).combine_chunks().dictionary_encode("encode") for c in ("term", "q_id"))
    at = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(at, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(terms.dictionary)))]).astype(np.int64)
    wq = held.column("wq").to_numpy()[order] if "wq" in held.column_names else np.ones(len(held))
    made = terms.dictionary, names.dictionary, first, names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[order], wq
    return (*made, order) if ordered else made


def _asked_of(part, terms):
    """The postings of a part with one of ``terms``: (term number, weight) by text, and the texts' sizes and bands."""
    import numpy as np
    import pyarrow.compute as pc

    w, band = part.weights()
    at = pc.fill_null(pc.index_in(part.terms, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)[part.at]
    held = np.flatnonzero(at >= 0)
    return at[held], w[held], np.diff(np.searchsorted(held, part.first)), band


def _blocks(at, w, sizes, first, n: int, cells: int):
    """Texts a block at a time: (a, b, cells, products' places, weights), no block over ``cells``."""
    import numpy as np

    ends = np.concatenate([[0], np.cumsum(sizes)])
    products = np.concatenate([[0], np.cumsum(first[at + 1] - first[at])])[ends]
    a = 0
    while a < len(sizes):
        b = int(np.searchsorted(products, products[a] + cells, side="right")) - 1
        b = max(a + 1, min(b, a + max(1, cells // n), len(sizes)))
        t, weight = at[ends[a]:ends[b]], w[ends[a]:ends[b]]
        many = first[t + 1] - first[t]
        spot = np.arange(many.sum()) + np.repeat(first[t] - np.cumsum(many) + many, many)
        text = np.repeat(np.repeat(np.arange(b - a) * n, sizes[a:b]), many)
        yield a, b, text, spot, np.repeat(weight, many)
        a = b


def _gathering(parts, asked, bands, lack):
    """Kernel: the pairs of a part's texts whose sum gets to what ``lack`` says of their band and query."""
    terms, places, queries, first, query, wq = asked
    cells, texts = BLOCK_CELLS, parts.texts

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n = len(queries)
        to = np.full((len(bands) + 1) * len(terms), -1, dtype=np.int32)
        to[places] = np.arange(len(places))
        for _, part in packed.parts_of(batches if n else [], texts):
            at, w, sizes, band = _asked_of(part, terms)
            place = np.searchsorted(bands, band)
            place[(place == len(bands)) | (bands[np.minimum(place, len(bands) - 1)] != band)] = len(bands)
            number = to[np.repeat(place, sizes) * len(terms) + at]
            held = np.flatnonzero(number >= 0)
            sizes = np.diff(np.searchsorted(held, np.concatenate([[0], np.cumsum(sizes)])))
            for a, b, text, spot, weight in _blocks(number[held], w[held], sizes, first, n, cells):
                cell = text + query[spot]
                score = np.bincount(cell, weight * wq[spot], (b - a) * n).astype("float64")
                met = np.zeros((b - a) * n, dtype=bool)
                met[cell] = True
                found = np.flatnonzero(met & (score >= lack[place[a:b]].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [queries.take(pa.array(found % n)), part.ids.take(pa.array(a + found // n))], ["q_id", "id"])

    return run


def _sharing(parts, asked):
    """Kernel: for each block of a part's texts, how many (query, text) pairs share a term."""
    terms, queries, first, query, _ = asked
    cells, texts = BLOCK_CELLS, parts.texts

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n = len(queries)
        for _, part in packed.parts_of(batches if n else [], texts):
            at, w, sizes, _ = _asked_of(part, terms)
            met_pairs = 0
            for a, b, text, spot, _ in _blocks(at, w, sizes, first, n, cells):
                met = np.zeros((b - a) * n, dtype=bool)
                met[text + query[spot]] = True
                met_pairs += int(met.sum())
            yield pa.RecordBatch.from_arrays([pa.array([met_pairs], pa.int64())], ["pairs"])

    return run


def sparse_search(queries: DataFrame, weights: DataFrame, k: int = TOP_K) -> tuple[DataFrame, DataFrame]:
    """The k best texts per query by cosine (q_id, id, score, stage1_rank), and the pairs (q_id, id) scored for it.

    Exact, with bounds in place of scoring every pair that shares a word; ``weights``
    are banded. Queries whose terms exceed a broadcast are searched a block after the other.
    The rarest terms of a query give it a few texts whose full scores set a
    bar, the k-th best of them. In each band its terms of least reach, as long as all of
    them together stay below ``REST_SHARE`` of the bar, cannot lift a text over it: only
    texts with one of the other terms are gathered, and of these only those whose score
    so far plus that remaining reach gets to the bar are scored in full.
    """
    asked = durable(queries.select("q_id", "term", F.col("weight").alias("wq")))
    found = [_search(block, weights, k) for block in _query_blocks(asked)]
    return tuple(reduce(DataFrame.unionByName, frames) for frames in zip(*found))


def _query_blocks(asked: DataFrame) -> list[DataFrame]:
    """``asked`` (q_id, ...) dealt out by query, no block much beyond what fits a broadcast; one frame if all does."""
    n = max(1, -(-asked.count() // max(1, SMALL_QUERY_TERMS)))
    block = F.pmod(F.xxhash64("q_id"), F.lit(n))
    return [asked] if n == 1 else [asked.filter(block == i) for i in range(n)]


def _search(asked: DataFrame, weights: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The search of :func:`sparse_search` for some queries."""
    reach = durable(term_reach(asked, weights))
    # the rarest terms until they promise enough texts
    frequency = reach.groupBy("q_id", "term").agg(F.sum("df").alias("df"), F.first("wq").alias("wq"))
    rare = Window.partitionBy("q_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    first = frequency.withColumn("_before", F.coalesce(F.sum("df").over(rare), F.lit(0))).filter(
        F.col("_before") < SEED_TEXTS * k).select("q_id", "term", "wq")
    first = durable(first)
    wanted = first.select("term").distinct()
    held = packed.weights_view(packed.pack_weights(weights), wanted.toArrow().column("term").combine_chunks()) if _few(wanted) else weights
    seeds = _matched(held, first, ["term"]).groupBy("q_id", "id").agg(F.sum(F.col("weight") * F.col("wq")).alias("score"))
    seeds = durable(_best(seeds, SEED_TEXTS * k, "_rank").select("q_id", "id"))
    # a query with fewer than k seeds has no bar
    bars = _best(_complete(seeds, weights, asked), k, "_rank").groupBy("q_id").agg(
        F.min("score").alias("_low"), F.count(F.lit(1)).alias("_n")).select(
        "q_id", F.when(F.col("_n") >= k, F.col("_low") - BAR_SLACK).otherwise(F.lit(0.0)).alias("bar"))
    inside = Window.partitionBy("q_id", "band")
    split = reach.join(bars, "q_id").withColumn(
        "_sum", F.sum("reach").over(inside.orderBy("reach", "term").rowsBetween(Window.unboundedPreceding, 0)))
    rest = F.max(F.when(F.col("_sum") < REST_SHARE * F.col("bar"), F.col("_sum")).otherwise(0.0)).over(inside)
    needed = durable(split.withColumn("rest", rest).filter(F.col("_sum") >= REST_SHARE * F.col("bar")).select(
        "q_id", "term", "band", "wq", "bar", "rest"))
    reached = durable(_reaching(weights, needed))
    scored = _complete(reached, weights, asked).withColumn("score", F.round("score", 6))
    return _best(scored, k, "stage1_rank"), reached


def _scored(parts, asked, k: int):
    """Kernel: the k best of a task's texts for each query, from packed parts.

    ``asked`` as of :func:`_by_term`. Some texts are scored at a time, so that scores and products of a block stay in a
    few dozen megabytes; a text below the k-th best so far of a query is no candidate of it.
    """
    terms, queries, first, query, wq = asked
    cells, texts = BLOCK_CELLS, parts.texts

    def best(rows):
        import numpy as np

        rows = rows.take(pc.sort_indices(
            rows, sort_keys=[("q", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_start"))
        q = rows.column("q").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, dtype=np.int64)
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        return rows.filter(pa.array(place < k)), q[place == k - 1], rows.column("score").to_numpy()[place == k - 1]

    def run(batches):
        import numpy as np

        n, kept, bar, waiting = len(queries), [], np.full(len(queries), -np.inf), 0
        for _, part in packed.parts_of(batches if n else [], texts):
            at, w, sizes, _ = _asked_of(part, terms)
            for a, b, text, spot, weight in _blocks(at, w, sizes, first, n, cells):
                cell = text + query[spot]
                score = np.bincount(cell, weight * wq[spot], (b - a) * n).astype("float64")
                met = np.zeros((b - a) * n, dtype=bool)
                met[cell] = True
                # rounding moves a score by less than what the bar is lowered by
                found = np.flatnonzero(met & (score.reshape(b - a, n) >= bar - BAR_SLACK).ravel())
                rounded = np.round(score[found], 6)
                found, rounded = found[rounded >= bar[found % n]], rounded[rounded >= bar[found % n]]
                kept.append(pa.table({"q": pa.array(found % n), "id": part.ids.take(pa.array(a + found // n)), "score": rounded}))
                waiting += len(found)
                if waiting > max(cells // 4, n * k):
                    rows, full, low = best(pa.concat_tables(kept).combine_chunks())
                    kept, bar[full] = [rows], low
                    waiting = 0
        if kept:
            rows = best(pa.concat_tables(kept).combine_chunks())[0]
            named = pa.table({"q_id": queries.take(rows.column("q").combine_chunks()), "id": rows.column("id"), "score": rows.column("score")})
            yield from named.to_batches(max_chunksize=50_000)

    import pyarrow as pa
    import pyarrow.compute as pc

    return run


def sparse_topk(queries: DataFrame, weights: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best texts per query by cosine: (q_id, id, score, stage1_rank).

    Query terms are scored where the weights lie: every text is multiplied with all queries that
    share a term of it, and only the k best of each leave the task. Queries whose terms exceed a broadcast are
    dealt out into blocks, each with a pass of its own over the packed weights.
    """
    parts = packed.pack_weights(weights)
    asked = durable(queries.select("q_id", "term", F.col("weight").alias("wq")))
    asked = asked.filter(F.col("term").isNotNull() & F.col("wq").isNotNull())
    blocks = _query_blocks(asked)
    kind = queries.schema["q_id"].dataType.simpleString()
    # as many tasks as run at a time: each keeps its best of all its parts
    width = TASKS_A_CORE * queries.sparkSession.sparkContext.defaultParallelism
    held = parts.parts if len(blocks) == 1 else parts.parts.coalesce(width)
    search = lambda block: _best(held.mapInArrow(_scored(parts, _by_term(block.toArrow()), k), f"q_id {kind}, id {parts.kind}, score double"),
                                 k, "stage1_rank")
    return search(asked) if len(blocks) == 1 else reduce(DataFrame.unionByName, [durable(search(block)) for block in blocks])


def sharing_pairs(queries: DataFrame, weights: DataFrame) -> DataFrame:
    """One row: how many (query, text) pairs share a term, which is what a search without bounds scores.

    Query terms that fit a broadcast are counted text by text where the weights lie.
    """
    asked = queries.select("q_id", "term").filter(F.col("term").isNotNull()).distinct()
    if not _few(asked):
        return _matched(weights, asked, ["term"]).select("q_id", "id").distinct().agg(F.count(F.lit(1)).alias("pairs"))
    parts = packed.pack_weights(weights)
    counts = parts.parts.mapInArrow(_sharing(parts, _by_term(asked.toArrow())), "pairs long")
    return counts.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))


def bm25_scores(candidates: DataFrame, questions: DataFrame, key: str, text: str, postings: DataFrame) -> DataFrame:
    """BM25 of each (q_id, id) candidate over the distinct question terms, rounded to 4 places."""
    n, avgdl = _text_stats(postings)
    terms = questions.select(F.col(key).alias("q_id"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))
    idf = F.log(1.0 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(document_frequency(postings), "term").select("q_id", "term", idf.alias("idf"))
    pair_terms = candidates.select("q_id", "id").join(weighted, "q_id")
    tf, scale = F.col("tf"), 1 - B + B * F.col("length") / avgdl
    gain = F.col("idf") * tf * (K1 + 1) / (tf + K1 * scale)
    held = packed.carried(postings)
    # the texts' own postings come from their parts
    around = postings if held is None else packed.postings_of(held, candidates.select("id"))
    scores = pair_terms.join(around, ["id", "term"]).groupBy("q_id", "id").agg(F.sum(gain).alias("_s"))
    return candidates.join(scores, ["q_id", "id"], "left").withColumn(
        "rerank_score", F.round(F.coalesce("_s", F.lit(0.0)), 4)).drop("_s")


def rerank(scored: DataFrame, score: str = "rerank_score", n: int = RERANK_N) -> DataFrame:
    """Keep the n best per query; equal scores keep their stage-one order."""
    order = Window.partitionBy("q_id").orderBy(F.desc(score), "stage1_rank")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def retrieve(questions: DataFrame, key: str, text: str, postings: DataFrame, k: int = TOP_K, n: int = RERANK_N) -> DataFrame:
    """Recall k texts per question, rerank them, keep n: (q_id, id, rank, rerank_score, ...)."""
    weights = banded_weights(postings)
    candidates = durable(sparse_topk(query_weights(questions, key, text, postings), weights, k))
    return rerank(bm25_scores(candidates, questions, key, text, postings), n=n)


def with_passages(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """Attach source id, name and text of each hit; ``passages`` is (id, source_id, name, passage)."""
    return hits.join(passages, "id")


def _in_rank_order(column: str):
    """Values of a query's hits by rank; a query keeps at most n hits, so the list is short."""
    return F.transform(F.array_sort(F.collect_list(F.struct("rank", column))), lambda h: h[column])


def format_context(hits: DataFrame) -> DataFrame:
    """Per query, the numbered and cited passages joined by blank lines."""
    block = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] ("), F.col("source_id").cast("string"),
                     F.lit(" — "), F.col("name"), F.lit(")\n"), F.col("passage"))
    return hits.withColumn("block", block).groupBy("q_id").agg(
        F.array_join(_in_rank_order("block"), "\n\n").alias("context"))


def retrieval_samples(hits: DataFrame) -> DataFrame:
    """Per query, contexts and source ids in rank order."""
    return hits.groupBy("q_id").agg(
        _in_rank_order("passage").alias("contexts"), _in_rank_order("source_id").alias("source_ids"))
