"""Benchmark decontamination over a distributed positional inverted index.

Native: DataFrame functions only. A benchmark item becomes its windows of ten
consecutive words. Training occurrences of every benchmark term are counted; the
postings (term, doc_id, pos) of the ``lists`` rarest terms of each window are stored,
sorted by term. A window's candidates are the offset-adjusted postings of its rarest
term, intersected with those of the next rarest; what remains is compared with the
whole phrase in the text. A window with a term that no document holds cannot occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import texts, written

#: Rows up to which a table of benchmark terms or windows is sent to every task; larger ones are joined by a shuffle.
SENT_ROWS = 200_000
#: The same for a single column of document ids.
SENT_IDS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z; a null has none."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(cut, "")


def _sent(table: DataFrame, bound: int = SENT_ROWS) -> DataFrame:
    """The table with a broadcast hint if it is counted within the bound."""
    return F.broadcast(table) if table.count() <= bound else table


def benchmark_windows(items: DataFrame, width: int = 10) -> DataFrame:
    """(item_id, win, size): distinct windows as words joined by spaces; shorter items are one window."""
    cut = items.filter(F.col("item_id").isNotNull()).select("item_id", item_words(F.col("text").cast("string")).alias("_w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - width + 1, F.lit(1)))
    each = cut.filter(F.size("_w") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("_w", i, width))).alias("_s"))
    return each.select("item_id", F.array_join("_s", " ").alias("win"), F.size("_s").alias("size")).distinct()


def term_postings(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc_id, pos from 0) of every occurrence of the given terms in whole texts."""
    docs = texts(documents)
    every = docs.select("doc_id", F.posexplode(item_words(F.col("text"))).alias("pos", "term"))
    return every.join(_sent(terms.select("term").distinct()), "term").select("term", "doc_id", "pos")


def build_index(documents: DataFrame, windows: DataFrame, lists: int = 2) -> tuple[DataFrame, DataFrame]:
    """(plans, postings) for the distinct windows.

    ``plans`` has (win, size, anchors): the ``lists`` rarest terms of a window with an
    offset each, rarest first. ``postings`` is the stored index of those terms.
    """
    distinct = windows.select("win", "size").distinct()
    spots = written(distinct.select("win", "size", F.posexplode(F.split("win", " ")).alias("off", "term")), "spots")
    vocabulary = spots.select("term").distinct()
    docs = texts(documents)
    counts = docs.select(F.explode(item_words(F.col("text"))).alias("term")).join(_sent(vocabulary), "term").groupBy(
        "term").agg(F.count(F.lit(1)).alias("tf"))
    counts = written(counts, "terms")
    known = spots.groupBy("win", "size", "term").agg(F.min("off").alias("off")).join(_sent(counts), "term", "left")
    # a window holds at most ``size`` terms
    plans = known.groupBy("win", "size").agg(
        F.array_sort(F.collect_list(F.struct("tf", "term", "off"))).alias("_a"), F.max(F.col("tf").isNull()).alias("_none"))
    plans = written(plans.filter(~F.col("_none")).select("win", "size", F.slice("_a", 1, lists).alias("anchors")), "plans")
    wanted = plans.select(F.explode("anchors").alias("_x")).select(F.col("_x.term").alias("term"))
    postings = term_postings(documents, wanted).sortWithinPartitions("term", "doc_id")
    return plans, written(postings, "postings")


def candidates(plans: DataFrame, postings: DataFrame, lists: int = 2) -> DataFrame:
    """(win, size, doc_id, start): places where the anchors of a window stand at their offsets."""
    first = _sent(plans.select("win", "size", "anchors", F.col("anchors")[0]["term"].alias("term"),
                               F.col("anchors")[0]["off"].alias("_off")))
    found = postings.join(first, "term").select("win", "size", "anchors", "doc_id", (F.col("pos") - F.col("_off")).alias("start"))
    found = found.filter("start >= 0")
    for i in range(1, lists):
        other = postings.select(F.col("term").alias("_term"), F.col("doc_id").alias("_doc"), F.col("pos").alias("_pos"))
        at = F.get("anchors", F.lit(i))
        # windows of fewer distinct terms pass: the placeholder row keeps them out of the join
        more = found.filter(F.size("anchors") > i).withColumns({"_t": at["term"], "_p": F.col("start") + at["off"]})
        more = more.join(other, (F.col("_t") == F.col("_term")) & (F.col("doc_id") == F.col("_doc")) & (F.col("_p") == F.col("_pos")), "left_semi")
        found = more.drop("_t", "_p").unionByName(found.filter(F.size("anchors") <= i))
    return found.select("win", "size", "doc_id", "start")


def phrase_hits(documents: DataFrame, windows: DataFrame, lists: int = 2) -> DataFrame:
    """(doc_id, cls, hits) of the texts in which windows occur; hits are their (win, size, start).

    ``cls`` hashes the text and tells rows of one doc_id apart; repeated rows give one.
    """
    plans, postings = build_index(documents, windows, lists)
    per_doc = written(candidates(plans, postings, lists).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_set(F.struct("win", "size", "start")).alias("_c")), "candidates")
    docs = texts(documents).withColumn("cls", F.xxhash64("text"))
    # only texts with candidates travel to them
    asked = docs.join(_sent(per_doc.select("_doc"), SENT_IDS), F.col("doc_id") == F.col("_doc"), "left_semi")
    # written words are split once; as an expression they would be split again for every candidate
    words = written(asked.select("doc_id", "cls", item_words(F.col("text")).alias("_w")).dropDuplicates(["doc_id", "cls"]), "words")
    same = lambda c: F.array_join(F.slice("_w", c["start"] + 1, c["size"]), " ") == c["win"]
    compared = words.join(per_doc, F.col("doc_id") == F.col("_doc")).select("doc_id", "cls", F.filter("_c", same).alias("hits"))
    # written before the empty ones go, or the comparison would run once more in the condition
    return written(compared, "hits").filter(F.size("hits") > 0)


def phrase_matches(documents: DataFrame, windows: DataFrame, lists: int = 2) -> DataFrame:
    """(doc_id, cls, n_words, hits) of every text, from :func:`phrase_hits`; hits are null where nothing occurs.

    Null texts have no words; rows without doc_id are left out; other columns are ignored.
    """
    hits = phrase_hits(documents, windows, lists).select(
        F.col("doc_id").alias("_doc"), F.col("cls").alias("_cls"), "hits")
    counted = texts(documents).select(
        "doc_id", F.xxhash64("text").alias("cls"), F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    return counted.join(hits, (F.col("doc_id") == F.col("_doc")) & (F.col("cls") == F.col("_cls")), "left").select(
        "doc_id", "cls", "n_words", "hits")


def proximity_matches(documents: DataFrame, phrases: DataFrame, within: int = 8) -> DataFrame:
    """(phrase_id, doc_id, pos): postings of a phrase's rarest term with all its other terms at most ``within`` words away.

    ``phrases`` is (phrase_id, text).
    """
    spots = phrases.select("phrase_id", F.explode(F.array_distinct(item_words(F.col("text")))).alias("term"))
    spots = written(spots, "phrases")
    postings = written(term_postings(documents, spots), "postings")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    ranked = spots.join(counts, "term", "left").groupBy("phrase_id").agg(
        F.array_sort(F.collect_list(F.struct("tf", "term"))).alias("_a"), F.max(F.col("tf").isNull()).alias("_none"))
    ranked = ranked.filter(~F.col("_none"))
    rare = ranked.select("phrase_id", F.col("_a")[0]["term"].alias("term"), F.size("_a").alias("_all"))
    found = postings.join(rare, "term").select("phrase_id", "_all", "doc_id", "pos")
    others = ranked.select("phrase_id", F.explode(F.slice("_a", 2, F.size("_a"))).alias("_x")).select(
        F.col("phrase_id").alias("_pid"), F.col("_x.term").alias("term"))
    # postings meet by blocks of positions, so no list is paired with another whole
    near = postings.join(others, "term").select(
        "_pid", "term", F.col("doc_id").alias("_doc"), F.col("pos").alias("_pos"),
        F.explode(F.sequence(F.floor((F.col("pos") - within) / within), F.floor((F.col("pos") + within) / within))).alias("_cell"))
    met = found.join(near, (F.col("phrase_id") == F.col("_pid")) & (F.col("doc_id") == F.col("_doc"))
                     & (F.floor(F.col("pos") / within) == F.col("_cell")) & (F.abs(F.col("pos") - F.col("_pos")) <= within))
    full = met.groupBy("phrase_id", "doc_id", "pos", "_all").agg(F.count_distinct("term").alias("_n")).filter("_n = _all - 1")
    alone = found.filter("_all = 1")
    return full.select("phrase_id", "doc_id", "pos").unionByName(alone.select("phrase_id", "doc_id", "pos"))


def report(documents: DataFrame, items: DataFrame, width: int = 10, lists: int = 2) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    windows = written(benchmark_windows(items, width), "benchmark")
    matches = written(phrase_matches(documents, windows, lists), "matches")
    spans = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1)))
    hit = matches.filter(F.size("hits") > 0)
    owners = windows.select("win", F.col("item_id").cast("string").alias("_item"))
    named = hit.select("doc_id", "cls", F.explode(F.array_distinct(F.transform("hits", lambda h: h["win"]))).alias("win")).join(
        _sent(owners), "win").groupBy("doc_id", "cls").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    named = named.select(F.col("doc_id").alias("_doc"), F.col("cls").alias("_cls"), "_items")
    joined = matches.join(written(named, "owners"), (F.col("doc_id") == F.col("_doc")) & (F.col("cls") == F.col("_cls")), "left")
    items_of = F.coalesce("_items", F.array().cast("array<string>"))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", count(F.when(F.size("hits") > 0, F.size(F.array_distinct(spans)))).alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"), F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        F.coalesce(F.size("hits") > 0, F.lit(False)).alias("contaminated"))


def clean(documents: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``documents`` in whose text no benchmark window occurs; rows without doc_id stay."""
    windows = written(benchmark_windows(items, width), "benchmark")
    bad = phrase_hits(documents, windows).select(F.col("doc_id").alias("__llm_id"), F.col("cls").alias("__llm_cls"))
    same = (documents["doc_id"].cast("long") == F.col("__llm_id")) & (F.xxhash64(documents["text"]) == F.col("__llm_cls"))
    return documents.join(bad, same, "left_anti")
