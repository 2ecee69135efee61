"""Documents, chunks, retrieval, vectors and run scores on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsleuth.functions.columns import cve_ids, technique_ids
from netsleuth.functions.schema import BUNDLE_OBJECT, CVE_SCHEMA
from netsleuth.operators import corpus, embeddings, retrieval, retrieval_eval, runs, signature_index, text_embedding


def test_parse_keeps_active_techniques_with_an_id(spark):
    rows = ['{"type":"attack-pattern","id":"a","name":"Phish","description":"Bait.","x_mitre_platforms":["Windows","Linux"],'
            '"kill_chain_phases":[{"phase_name":"initial-access"}],"external_references":[{"source_name":"mitre-attack","external_id":"T1566","url":"u"}]}',
            '{"type":"attack-pattern","id":"b","name":"Old","description":"x","x_mitre_deprecated":true,"external_references":[{"source_name":"mitre-attack","external_id":"T1"}]}',
            '{"type":"attack-pattern","id":"d","name":"NoId","description":"x"}', '{"type":"relationship","id":"c"}']
    objects = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", BUNDLE_OBJECT).alias("o")).select("o.*")
    docs = corpus.parse_techniques(objects).collect()
    assert len(docs) == 1 and docs[0]["technique_id"] == "T1566" and docs[0]["url"] == "u"
    assert docs[0]["text"] == ("MITRE ATT&CK Technique T1566: Phish\nTactics: initial-access\nPlatforms: Windows, Linux\n\nBait.")


TEXTS = ["", "short", "x" * 900, "x" * 901, "y" * 780, "z" * 1680, "é\n" * 1500,
         "First paragraph here. With two sentences.\n\n" * 60, "word " * 700, "a" * 5000]


def test_fixed_chunks_against_slices(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {}
    for r in corpus.chunk_fixed(df).orderBy("i", "chunk_no").collect():
        got.setdefault(r["i"], []).append(r["chunk_text"])
    for i, text in enumerate(TEXTS):
        n = max(1, -(-(len(text) - 120) // 780)) if text else 0
        assert got.get(i, []) == [text[k * 780:k * 780 + 900] for k in range(n)]


def test_recursive_chunks_properties(spark):
    """Chunks are in-order substrings within the size, and no word is lost."""
    words = [f"w{i}" for i in range(2500)]
    texts = ["", "short", " ".join(words), "\n".join(words), ". ".join(words),
             "\n\n".join(" ".join(words[i:i + 40]) + "." for i in range(0, 2500, 40)),
             "".join(chr(0x4E00 + i) for i in range(4000)), "w " + "".join(chr(0x4E00 + i) for i in range(2000)) + "\n\nend"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {}
    for r in corpus.chunk_recursive(df).orderBy("i", "chunk_no").collect():
        got.setdefault(r["i"], []).append(r["chunk_text"])
    for i, text in enumerate(texts):
        at, covered = 0, set()
        for piece in got.get(i, []):
            assert 0 < len(piece) <= 900
            at = text.index(piece, at)
            covered.update(range(at, at + len(piece)))
        assert all(k in covered for k, ch in enumerate(text) if not ch.isspace())


def test_extract_ids(spark):
    df = spark.createDataFrame([(1, "T1566.001 and T1566.001, T1059; CVE-2021-44228 xT12345")], "k int, text string")
    found = {(r["mention"], r["parent"]) for r in corpus.extract_ids(df, "k", technique_ids(F.col("text"))).collect()}
    assert found == {("T1566.001", "T1566"), ("T1059", "T1059")}
    assert [r["mention"] for r in corpus.extract_ids(df, "k", cve_ids(F.col("text"))).collect()] == ["CVE-2021-44228"]


DOCS = ["the cat sat on the mat", "the dog sat on the log", "cats and dogs and the birds", "a the the the the",
        "quantum flux capacitor of the lab", "the quantum cat"]


def test_retrieval_against_brute_force(spark):
    import math
    from collections import Counter

    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(DOCS)], "id string, text string")
    asked = spark.createDataFrame([(1, "the quantum cat"), (2, "dog log"), (3, "zebra")], "q int, text string")
    postings = retrieval.build_postings(docs, "id", "text")
    bags = [Counter(t.split()) for t in DOCS]
    df = Counter(w for b in bags for w in b)
    weigh = lambda bag: {w: c * math.log((len(DOCS) + 1) / (df.get(w, 0) + 1)) + c for w, c in bag.items()}
    unit = lambda v: {w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}
    vectors = [unit(weigh(b)) for b in bags]
    want = {}
    for q, text in ((1, "the quantum cat"), (2, "dog log")):
        qv = unit(weigh(Counter(text.split())))
        scored = [(round(sum(qv.get(w, 0) * x for w, x in v.items()), 6), f"d{i}") for i, v in enumerate(vectors)]
        want[q] = [(d, s) for s, d in sorted(scored, key=lambda p: (-p[0], p[1])) if s > 0][:3]
    queries = retrieval.query_weights(asked, "q", "text", postings)
    for bound in (retrieval.SMALL_QUERY_TERMS, 0):
        retrieval.SMALL_QUERY_TERMS, saved = bound, retrieval.SMALL_QUERY_TERMS
        hits = retrieval.sparse_topk(queries, retrieval.banded_weights(postings), 3).orderBy("q_id", "stage1_rank").collect()
        retrieval.SMALL_QUERY_TERMS = saved
        got = {}
        for r in hits:
            got.setdefault(r["q_id"], []).append((r["id"], r["score"]))
        assert {q: [d for d, _ in v] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items()}
    best = retrieval.retrieve(asked, "q", "text", postings, 3, 2).filter("rank = 1")
    assert {r["q_id"]: r["id"] for r in best.collect()} == {1: "d5", 2: "d1"}


def test_search_by_bounds_is_exact_and_scores_less(spark):
    rng = np.random.default_rng(6)
    lexicon = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    odds = 1 / np.arange(1, 101)
    texts = [" ".join(rng.choice(lexicon, int(rng.integers(1, 60)), p=odds / odds.sum())) for _ in range(400)]
    texts += ["ak ak ak ak"] * 30  # ties, and a text of one common term
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "id string, text string")
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:12] + ["ak", "zz", "ak zz jt"])], "q int, text string")
    postings = retrieval.build_postings(docs, "id", "text")
    queries = retrieval.query_weights(asked, "q", "text", postings)
    weights = retrieval.banded_weights(postings)
    hits, reached = retrieval.sparse_search(queries, weights, 5)
    plain = retrieval.sparse_topk(queries, weights, 5)
    rows = lambda df: sorted((r["q_id"], r["stage1_rank"], r["id"], r["score"]) for r in df.collect())
    assert rows(hits) == rows(plain) and len(rows(hits)) > 60
    pairs = retrieval.sharing_pairs(queries, weights).first()["pairs"]
    assert len(rows(hits)) <= reached.count() < 0.6 * pairs
    assert reached.distinct().count() == reached.count()


def test_bounds_are_met_where_the_texts_lie(spark, monkeypatch):
    """Pairs are gathered and counted text by text, with the rows of the joined form, twice-asked terms and null ids too."""
    texts = [("d1", "a b c"), ("d1", "a b c"), ("d2", "b c d e"), (None, "a e"), ("d4", "zz"), ("d5", "c c c a")]
    docs = spark.createDataFrame(texts, "id string, text string")
    asked = spark.createDataFrame([(1, "a b q"), (2, "c c e"), (None, "a"), (3, "nothing")], "q int, text string")
    postings = retrieval.build_postings(docs, "id", "text")
    queries = retrieval.query_weights(asked, "q", "text", postings)
    weights = retrieval.banded_weights(postings)
    needed = queries.unionByName(queries.limit(2)).select("q_id", "term", F.col("weight").alias("wq")).join(
        weights.select("term", "band").distinct(), "term").withColumns({"bar": F.lit(0.3), "rest": F.lit(0.05)})
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    own = retrieval._reaching(weights, needed.filter("q_id is not null"))
    counted = retrieval.sharing_pairs(queries, weights)
    # neither moves its pairs: they leave the kernel as hits or as one count
    assert all("MapInArrow" in df._jdf.queryExecution().toString() for df in (own, counted))
    found = rows(own), rows(counted)
    assert found[1] == [(11,)] and 0 < len(found[0]) < 8
    monkeypatch.setattr(retrieval, "SMALL_QUERY_TERMS", 0)
    assert (rows(retrieval._reaching(weights, needed.filter("q_id is not null"))), rows(retrieval.sharing_pairs(queries, weights))) == found


def test_index_parts_follow_the_text(spark, monkeypatch):
    """More text makes more tasks, not larger ones, in the counting, the lookup of frequencies and the norms."""
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.choice(["ab", "cd", "ef", "gh", "ij"], 30))) for i in range(300)] + [(None, "ab ab"), (7, None)]
    docs = spark.createDataFrame(texts, "id int, text string")
    rows = lambda df: sorted((str(r["id"]), r["term"], round(r["weight"], 9), r["band"]) for r in df.collect())
    plain = rows(retrieval.banded_weights(retrieval.build_postings(docs, "id", "text")))
    monkeypatch.setattr(retrieval, "PART_BYTES", 1000)
    postings = retrieval.build_postings(docs, "id", "text")
    size = sum(len(t or "") for _, t in texts)
    weights = retrieval.banded_weights(postings)
    assert postings.rdd.getNumPartitions() == -(-size // 1000) > 8
    assert weights.rdd.getNumPartitions() == postings.rdd.getNumPartitions()
    assert rows(weights) == plain


def test_weights_come_from_packed_parts(spark, monkeypatch):
    """Weights and postings are views of the stored parts, without a shuffle of their rows; nulls and repeated ids count as before."""
    from collections import Counter

    monkeypatch.setattr(retrieval, "PART_BYTES", 40)
    texts = [("d1", "a b c"), ("d1", "a b c"), ("d1", "a z"), ("d2", "b c d e"), (None, "a e"), (None, "a e"), ("d4", None), ("d5", "12 3"), ("d6", "c c a")]
    docs = spark.createDataFrame(texts, "id string, text string")
    postings = retrieval.build_postings(docs, "id", "text")
    want = Counter((i, len(t.split()), w) for i, t in texts if t and i != "d5" for w in t.split())
    assert sorted(map(tuple, postings.select("id", "length", "term", "tf").collect()), key=str) == sorted(((*k, n) for k, n in want.items()), key=str)
    df = Counter(w for _, _, w in want)
    assert dict(retrieval.document_frequency(postings).collect()) == df
    ids = {i for i, _, _ in want}
    raw = {k: n * np.log((len(ids) + 1) / (df[k[2]] + 1)) + n for k, n in want.items()}
    norm = {i: np.sqrt(sum(v * v for k, v in raw.items() if k[0] == i)) for i in ids}
    weights = retrieval.banded_weights(postings)
    assert "Exchange" not in weights._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r["id"], r["term"], round(r["weight"], 9), r["band"]) for r in weights.collect()), key=str)
    assert got == sorted(((i, w, round(v / norm[i], 9), int(np.floor(2 * np.log2(norm[i])))) for (i, _, w), v in raw.items()), key=str)


def test_more_query_terms_than_a_broadcast_go_in_blocks(spark, monkeypatch):
    """Queries are dealt out, none is searched over shuffled weights, and the hits are those of one pass."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(list("abcdefgh"), int(rng.integers(1, 9)))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "a b")], "id int, text string")
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:15])] + [(None, "a c"), (20, "none")], "q int, text string")
    postings = retrieval.build_postings(docs, "id", "text")
    queries = retrieval.query_weights(asked, "q", "text", postings)
    weights = retrieval.banded_weights(postings)
    rows = lambda df: sorted((tuple(r) for r in df.select("q_id", "id", "score", "stage1_rank").collect()), key=str)
    plain, bounded = rows(retrieval.sparse_topk(queries, weights, 4)), rows(retrieval.sparse_search(queries.filter("q_id is not null"), weights, 4)[0])
    monkeypatch.setattr(retrieval, "SMALL_QUERY_TERMS", 11)
    assert rows(retrieval.sparse_search(queries.filter("q_id is not null"), weights, 4)[0]) == bounded
    monkeypatch.setattr(retrieval, "_matched", None)
    assert rows(retrieval.sparse_topk(queries, weights, 4)) == plain and len(plain) > 50


def test_rerank_keeps_stage_one_order_on_ties(spark):
    rows = [(1, "a", 1, 0.5), (1, "b", 2, 0.9), (1, "c", 3, 0.5)]
    got = retrieval.rerank(spark.createDataFrame(rows, "q_id int, id string, stage1_rank int, rerank_score double"), n=2)
    assert [r["id"] for r in got.orderBy("rank").collect()] == ["b", "a"]


def test_context_and_samples(spark):
    hits = spark.createDataFrame([(1, 2, "T2", "Two", "beta"), (1, 1, "T1", "One", "alpha")],
                                 "q_id int, rank int, source_id string, name string, passage string")
    assert retrieval.format_context(hits).first()["context"] == "[1] (T1 — One)\nalpha\n\n[2] (T2 — Two)\nbeta"
    sample = retrieval.retrieval_samples(hits).first()
    assert sample["contexts"] == ["alpha", "beta"] and sample["source_ids"] == ["T1", "T2"]
    questions = spark.createDataFrame([(1,), (2,)], "q_id int")
    replies = {r["q_id"]: r["reply"] for r in runs.attack_search(questions, hits).collect()}
    assert replies == {1: "T1 — One: alpha\n\nT2 — Two: beta", 2: "No matching ATT&CK techniques found."}
    mapped = {r["q_id"]: r["technique"] for r in runs.map_indicator(questions, hits).collect()}
    assert mapped == {1: "T1 — One", 2: "No technique match."}


@pytest.mark.parametrize("bound", [4096, 5])
def test_vector_topk_both_ways(spark, bound, monkeypatch):
    monkeypatch.setattr(embeddings, "MAX_QUERIES", bound)
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 8))
    v[50:120] = v[50]  # a third are copies
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    q = v[::20]
    held = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<double>")
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "q_id int, vector array<double>")
    got = {}
    for r in embeddings.vector_topk(asked, held, 12).collect():
        got.setdefault(r["q_id"], {})[r["rank"]] = r["id"]
    for i, x in enumerate(q):
        order = sorted(range(200), key=lambda j: (-round(float(v[j] @ x), 6), j))[:12]
        assert [got[i][k] for k in range(1, 13)] == order


def test_signature_index_against_the_exact_search(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 16))
    v[200:400] = v[200]  # a third are copies: one hot bucket in every table
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    held = spark.createDataFrame([(i, x.tolist(), "c") for i, x in enumerate(v)] + [(900, None, "c")], "id long, vector array<double>, votes string")
    asked = spark.createDataFrame([(i, (3 * v[i]).tolist()) for i in (0, 5, 200, 599)], "q_id int, vector array<double>")
    shape = signature_index.Signature(tables=20, bits=8, probes=16, votes=3)
    planes = shape.planes(16)
    assert np.allclose(np.einsum("tbd,tcd->tbc", planes, planes), np.eye(8)[None])
    products = np.einsum("nd,tbd->ntb", v, planes)
    votes = {}
    for q in (0, 5, 200, 599):
        for t in range(20):
            masks = sorted(range(256), key=lambda m: (sum(products[q, t, b] ** 2 for b in range(8) if m >> b & 1), m))[:16]
            own = sum(int(products[q, t, b] > 0) << b for b in range(8))
            for i in range(600):
                votes[q, i] = votes.get((q, i), 0) + (sum(int(products[i, t, b] > 0) << b for b in range(8)) ^ own in masks)
    hits, found = signature_index.index_topk(asked, held, 12, shape)
    want = {k: n for k, n in votes.items() if n >= 3}
    assert {(r["q_id"], r["id"]): r["votes"] for r in found.collect()} == want
    got = {}
    for r in hits.collect():
        got.setdefault(r["q_id"], {})[r["rank"]] = (r["id"], r["score"])
    for q in (0, 5, 200, 599):
        order = sorted((i for k, i in want if k == q), key=lambda j: (-round(float(v[j] @ v[q]), 6), j))[:12]
        assert [got[q][k][0] for k in range(1, len(order) + 1)] == order
        assert got[q][1][1] == pytest.approx(1.0)
    report = signature_index.search_report(hits, embeddings.vector_topk(asked, held.filter("vector is not null").select("id", "vector"), 12), found, asked, held).first()
    assert report["hits"] == 48 and report["recall"] > 0.9 and report["scored"] == len(want)
    assert report["scored_share"] == round(len(want) / (4 * 601), 4)


def test_signature_index_without_rows(spark):
    none = spark.createDataFrame([], "id long, vector array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "q_id int, vector array<double>")
    hits, found = signature_index.index_topk(asked, none, 3, signature_index.Signature(tables=2, bits=2, probes=2, votes=1))
    assert hits.count() == 0 and found.count() == 0


def test_passages_containing(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota"
    docs = spark.createDataFrame([(1, "x " + passage + " y"), (2, passage.replace("eta", "beta")), (3, passage[:-1]), (4, "pre" + passage)],
                                 "doc_id int, text string")
    asked = spark.createDataFrame([(9, passage)], "q_id int, passage string")
    assert {r["doc_id"] for r in retrieval_eval.passages_containing(asked, docs).collect()} == {1, 4}


def test_passages_of_any_length(spark):
    bodies = {1: "The quick brown fox jumps over the lazy dog", 2: "quick brown foxes", 3: "a lazy dog", 4: None, 5: "brow", 6: "12 34"}
    docs = spark.createDataFrame(list(bodies.items()), "doc_id int, text string")
    asked = ["quick", "brow", "ick brown fo", "lazy dog", "he quick brown fox jumps ov", "quick brown fox jumps over the lazy dog", "2 3", "dog a", None, "", "x", "a ", "og", "ogre", "é"]
    table = spark.createDataFrame(list(enumerate(asked)), "q_id int, passage string")
    got = {(r["q_id"], r["doc_id"]) for r in retrieval_eval.passages_containing(table, docs).collect()}
    assert got == {(q, d) for q, p in enumerate(asked) for d, t in bodies.items() if p is not None and t is not None and p in t}


def test_precision_and_recall(spark):
    hits = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 1)], "q_id int, item string, rank int")
    relevant = spark.createDataFrame([(1, "a"), (1, "c"), (1, "z"), (3, "q")], "q_id int, item string")
    precision = {r["q_id"]: r["context_precision"] for r in retrieval_eval.context_precision(hits, relevant).collect()}
    assert precision == {1: round((1 + 2 / 3) / 2, 4), 2: 0.0}
    recall = {r["q_id"]: r["context_recall"] for r in retrieval_eval.context_recall(hits, relevant).collect()}
    assert recall == {1: 0.6667, 3: 0.0}


def test_groundedness(spark):
    contexts = spark.createDataFrame([(1, 0, "the red fox"), (1, 1, "late words")], "run int, turn int, text string")
    answers = spark.createDataFrame([(1, 1, "the red car. late words here"), (1, 2, "late words"), (2, 1, "")], "run int, turn int, answer string")
    got = {(r["run"], r["turn"]): r["groundedness"] for r in retrieval_eval.groundedness(answers, contexts).collect()}
    assert got == {(1, 1): 0.5, (1, 2): 1.0, (2, 1): None}


def test_cve_lookup(spark):
    rows = ['{"id":"CVE-1","descriptions":[{"lang":"fr","value":"non"},{"lang":"en","value":"Bad bug"}],'
            '"metrics":{"cvssMetricV31":[],"cvssMetricV30":[{"cvssData":{"baseScore":9.8,"baseSeverity":"CRITICAL"}}],"cvssMetricV2":[{"cvssData":{"baseScore":5.0}}]}}',
            '{"id":"CVE-2","descriptions":[],"metrics":{"cvssMetricV2":[{"cvssData":{"baseScore":10.0}}]}}', '{"id":"CVE-3"}']
    cves = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", CVE_SCHEMA).alias("c")).select("c.*")
    asked = spark.createDataFrame([(" CVE-1",), ("CVE-2",), ("CVE-3",), ("CVE-9",)], "cve_id string")
    assert {r["reply"] for r in runs.cve_lookup(asked, cves).collect()} == {
        " CVE-1: CVSS 9.8 (CRITICAL). Bad bug", "CVE-2: CVSS 10.0 (n/a). (no description)",
        "CVE-3: CVSS unknown. (no description)", "No NVD record found for CVE-9."}


def test_run_scores(spark):
    tasks = spark.createDataFrame([(1, "cve", ["T1190", "cve-1"]), (2, "cve", ["T1"]), (3, "a", []), (4, "a", []), (5, "a", [])],
                                  "run int, expected_tool string, expected_contains array<string>")
    arrays = spark.createDataFrame([(1, ["cve", "map"]), (2, ["map"]), (3, ["a"] * 5), (4, []), (5, list("abcabca"))], "run int, trajectory array<string>")
    answers = spark.createDataFrame([(1, "CVE-1 is t1190"), (2, "none"), (3, "x"), (4, "x"), (5, "x")], "run int, answer string")
    got = {r["run"]: (r["tool_selection_ok"], r["task_completed"], r["trajectory_valid"])
           for r in runs.score_runs(tasks, runs.steps_of(arrays), answers).collect()}
    assert got == {1: (True, True, True), 2: (False, False, True), 3: (True, True, False), 4: (False, True, False), 5: (True, True, False)}


def test_long_run_steps_are_in_order(spark, monkeypatch):
    monkeypatch.setattr(runs, "TURNS_PER_BUCKET", 10)
    messages = spark.range(100).select(F.lit(1).alias("run"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, F.col("id").cast("string")).alias("tool"), F.lit("t").alias("text"))
    rows = runs.trajectories(messages).orderBy("step").collect()
    assert [r["tool"] for r in rows] == [str(i) for i in range(1, 100, 2)] and [r["step"] for r in rows] == list(range(1, 51))


def test_recursive_chunks_without_an_empty_separator(spark):
    body = "aaaa bbbb\ncccccccccccccccc dd"
    df = spark.createDataFrame([(body,)], "text string")
    got = [r["chunk_text"] for r in corpus.chunk_recursive(df, size=6, overlap=0, separators=["\n", " "]).orderBy("chunk_no").collect()]
    assert max(map(len, got)) <= 6 and "".join("".join(got).split()) == "".join(body.split())


def test_text_embedding_is_near_the_best_subspace(spark):
    rng = np.random.default_rng(2)
    topics = [[f"t{a}{chr(98 + b)}" for b in range(20)] for a in "xyz"]
    names = [f"d{i}" for i in range(90)]
    rows = [(d, t, float(w)) for i, d in enumerate(names) for t, w in zip(rng.choice(topics[i % 3], 12, replace=False), rng.random(12))]
    length = {d: np.sqrt(sum(w * w for e, _, w in rows if e == d)) for d in names}
    rows = [(str(d), str(t), float(w / length[d])) for d, t, w in rows]
    weights = spark.createDataFrame(rows, "id string, term string, weight double")
    terms = sorted({t for _, t, _ in rows})
    x = np.zeros((90, len(terms)))
    for d, t, w in rows:
        x[int(d[1:]), terms.index(t)] = w
    made = text_embedding.embed_text(weights, dim=8, power=2)
    best = np.linalg.svd(x, compute_uv=False) ** 2
    assert 0.95 * best[:8].sum() / best.sum() < made.captured <= best[:8].sum() / best.sum() + 1e-9
    basis = np.array([[r[f"y{j}"] for j in range(8)] for r in made.basis.orderBy("id").collect()])
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-9)
    held = {r["id"]: np.array(r["vector"]) for r in made.texts.collect()}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-9 for v in held.values())
    same = np.mean([held[a] @ held[b] for a in names[:30] for b in names[:30] if (int(a[1:]) - int(b[1:])) % 3 == 0])
    other = np.mean([held[a] @ held[b] for a in names[:30] for b in names[:30] if (int(a[1:]) - int(b[1:])) % 3])
    assert same > other + 0.4
    # a question made of a text's own terms lies where the text lies
    asked = spark.createDataFrame([(1, t, w) for d, t, w in rows if d == "d7"] + [(2, "unknown", 1.0)], "q_id int, term string, weight double")
    (only,) = text_embedding.embed_queries(asked, made).collect()
    assert only["q_id"] == 1 and np.dot(only["vector"], held["d7"]) / np.linalg.norm(only["vector"]) > 0.99
    narrow = text_embedding.embed_text(weights.filter("id in ('d0', 'd1')"), dim=6)
    assert narrow.dim == 2 and narrow.captured == pytest.approx(1.0)
    none = text_embedding.embed_text(weights.limit(0), dim=3)
    assert none.dim == 0 and none.captured == 0.0 and none.texts.count() == 0


def test_embedding_sends_terms_of_parts_not_postings(spark, monkeypatch):
    """What travels in a pass is one row for each term of a part, however many texts hold it."""
    sent, plain = [], text_embedding.by_part
    monkeypatch.setattr(text_embedding, "by_part", lambda parts, told, *more: sent.append(told.count()) or plain(parts, told, *more))
    rows = [(f"d{i}", f"t{j}", 0.25) for i in range(200) for j in range(i % 7, i % 7 + 16)]
    weights = spark.createDataFrame(rows, "id string, term string, weight double")
    made = text_embedding.embed_text(weights, dim=5)
    assert made.texts.count() == 200 and len(sent) == 2
    assert max(sent) <= 22 * int(spark.conf.get("spark.sql.shuffle.partitions")) < len(rows) / 10


def plain_chunks(body, size, overlap, separators):
    """Recursive cutter of one text, for comparison."""
    def pieces_of(part, seps):
        if len(part) <= size:
            return [part]
        level, sep = next(((i, s) for i, s in enumerate(seps) if s and s in part), (len(seps), ""))
        if sep == "":
            return list(part)
        head, *rest = part.split(sep)
        return [x for p in [head, *[sep + r for r in rest]] if p for x in pieces_of(p, seps[level + 1:])]

    chunks, held = [], []
    for piece in pieces_of(body, separators):
        if held and len("".join(held)) + len(piece) > size:
            chunks.append("".join(held).strip())
            while held and (len("".join(held)) > overlap or len("".join(held)) + len(piece) > size):
                held.pop(0)
        held.append(piece)
    return [c for c in [*chunks, "".join(held).strip()] if c]


def test_recursive_chunks_equal_a_plain_cutter(spark):
    rng = random.Random(4)
    marks = ["\n\n", "\n", ". ", " ", "a", "bb", "\u4e00", "\U0001f600", "\u2003", "word "]
    texts = ["".join(rng.choices(marks, k=rng.randrange(1, 160))) for _ in range(300)] + ["", None, " ", "\n" * 70, "x" * 95]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, chunk_note string")
    for size, overlap, seps in [(20, 6, corpus.SEPARATORS), (7, 7, corpus.SEPARATORS), (12, 0, [". ", " "]), (30, 12, ["\n", ""])]:
        got = {}
        for r in corpus.chunk_recursive(df, size=size, overlap=overlap, separators=seps).orderBy("i", "chunk_no").collect():
            assert r["chunk_no"] == len(got.setdefault(r["i"], []))
            got[r["i"]].append(r["chunk_text"])
        assert all(got.get(i, []) == plain_chunks(t or "", size, overlap, seps) for i, t in enumerate(texts)), (size, overlap)
    held = corpus.chunk_coverage(df, "i", size=20, overlap=6).collect()
    assert len(held) == sum(bool(t) for t in texts)
    assert all(r["covered"] == len(texts[r["i"]]) and r["longest_fits"] and r["in_order"] for r in held)
    assert corpus.chunk_recursive(df.limit(0)).columns == ["i", "chunk_note", "chunk_no", "chunk_text"]


def test_coverage_cuts_each_text_once(spark):
    """No filter on the spans, which the optimizer would push down with the whole cutting inside."""
    text = "word " * 4000
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "i int, text string")
    made = corpus.chunk_coverage(df, "i")
    assert [tuple(r) for r in made.collect()] == [(1, len(text), True, True)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert all("aggregate(" not in line for line in plan.splitlines() if "Filter " in line)


@pytest.mark.parametrize("cells", [1, 7, 1 << 21])
def test_topk_in_blocks_of_any_size(spark, cells, monkeypatch):
    """Texts are scored with all queries inside the task; ties go by id, and null ids are ids."""
    monkeypatch.setattr(retrieval, "BLOCK_CELLS", cells)
    words = [f"w{i}" for i in range(9)]
    rng = np.random.default_rng(3)
    held = [(f"é{i}" if i % 3 else f"d{i}", w, float(rng.integers(1, 4)) / 4) for i in range(40) for w in words if rng.random() < 0.4]
    held += [(None, "w1", 0.75), (None, "w2", 0.75)] + [(f"c{i}", "w1", 0.5) for i in range(30)]
    asked = [(q, w, float(rng.integers(1, 4)) / 4) for q in [1, 2, None] for w in words if rng.random() < 0.5] + [(4, "none", 1.0), (5, "w1", 1.0)]
    weights = spark.createDataFrame(held, "id string, term string, weight double")
    queries = spark.createDataFrame(asked, "q_id int, term string, weight double")
    got = retrieval.sparse_topk(queries, weights, 4)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    want = set()
    for q in {a[0] for a in asked}:
        score = {}
        for q_id, term, wq in asked:
            for i, t, w in held:
                if q_id == q and t == term:
                    score[i] = score.get(i, 0.0) + w * wq
        best = sorted(score, key=lambda i: (-score[i], i is not None, (i or "").encode()))[:4]
        want |= {(q, i, round(score[i], 6), n + 1) for n, i in enumerate(best)}
    assert {(r["q_id"], r["id"], r["score"], r["stage1_rank"]) for r in got.collect()} == want
    assert retrieval.sparse_topk(queries.limit(0), weights, 4).count() == 0 == retrieval.sparse_topk(queries, weights.limit(0), 4).count()
