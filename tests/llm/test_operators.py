"""Each operator against brute force on small tables with nulls, empty and repeated rows, ties and clashing columns."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from netsleuth.llm import (
    contamination, embedding_dedup, language_model, ngram_jaccard, packing, quality, shared, substring_dedup, toxicity,
    url_filter, wavelet)

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cls string, n string, key string, component_id int"
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def item_words(text):
    low = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    lexicon = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(lexicon, n))
    passage = prose(70)
    texts = {1: None, 2: "", 3: " \n\t ", 4: "one", 5: "One", 6: "two words", 7: prose(300)}
    texts[8] = texts[7]
    texts[9] = texts[7].replace(" ", "\n", 3)
    texts[10] = texts[7] + " extra words at the end"
    texts[11] = " ".join(words_ if i != 150 else "CHANGED" for i, words_ in enumerate(texts[7].split()))
    texts[12] = prose(40) + " " + passage + " " + prose(40)
    texts[13] = passage + " " + prose(20)
    texts[14] = prose(20) + " " + passage
    texts[15] = "spam " * 500
    texts[16] = "spam " * 501
    texts[17] = prose(30_000)
    texts[18] = "x" * 100_000
    texts[19] = "tab\tand\x0bvertical\x0cfeed\r\nline\u00a0nbsp \u2028 sep"
    for i in range(20, 40):
        texts[i] = prose(int(rng.integers(1, 120)))
    return [(i, t, None if i % 3 else "en", None, None if t is None else len(t), "a", "b", None, 7) for i, t in texts.items()]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EMPTY)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], r[0] % 2, r[0] % 2) for r in rows] + [(None, 1, 1), (4, None, None)],
                                 "doc_id long, quality int, toxic int")


def groups_of(sets, num, den):
    ids = sorted(i for i in sets if sets[i])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("width,num,den", [(3, 9, 10), (5, 8, 10)])
def test_jaccard_components(docs, rows, width, num, den):
    sets = {}
    for r in rows:
        w = words(r[1], True)
        sets[r[0]] = {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    want = groups_of(sets, num, den)
    got = {r["doc_id"]: r for r in ngram_jaccard.jaccard_components(docs, width, num, den).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in sets}


def test_jaccard_walk_finds_every_component_of_a_large_tile():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2 ** 63, 200).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, len(base) - k, replace=False), rng.integers(0, 2 ** 63, k).astype(np.uint64)]))
            for k in rng.integers(0, 30, 120)]
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    bits = ngram_jaccard._Bitmaps([ngram_jaccard._bitmap(s, 4096 if i % 3 else 1024).tobytes() for i, s in enumerate(sets)])
    near = lambda i, j: 10 * len(np.intersect1d(sets[i], sets[j])) >= 9 * len(np.union1d(sets[i], sets[j]))
    want = groups_of({i: set(s.tolist()) for i, s in enumerate(sets)}, 9, 10)
    links = ngram_jaccard._walk(bits, sizes, 9, 10, near)
    root = {i: i for i in range(len(sets))}
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in links:
        x, y = sorted((find(i), find(j)))
        assert x != y
        root[y] = x
    assert {i: find(i) for i in root} == want


@pytest.mark.parametrize("num,den", [(8, 10), (9, 10)])
def test_bitmaps_tell_unrelated_sets_of_any_size_apart(num, den):
    rng = np.random.default_rng(8)
    for n in (40, 600, 1200, 2500, 20_000):
        base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        # the others: unrelated, then as far from the first as the similarity just allows, and a little larger
        far = [np.unique(rng.integers(0, 2 ** 63, int(n * f)).astype(np.uint64)) for f in (1, 0.97, 1.05, 1, 1, 1, 1, 1)]
        lost = n * (den - num) // (den + num)
        near = [np.unique(np.concatenate([rng.choice(base, len(base) - lost, replace=False),
                                          rng.integers(0, 2 ** 63, lost).astype(np.uint64)])) for _ in range(4)]
        sets = [base, *far, *near]
        sizes = np.array([len(s) for s in sets])
        bits = ngram_jaccard._Bitmaps([ngram_jaccard._bitmap(s, ngram_jaccard._bits_for(len(s), num, den)).tobytes() for s in sets])
        others = np.arange(1, len(sets))
        assert set(ngram_jaccard._near(bits, sizes, 0, others, num, den).tolist()) == set(others[len(far):].tolist())
        # the bit counts never say more than the sets differ by, whatever widths are compared
        for j in others:
            assert bits.apart(0, np.array([j]))[0] <= len(np.setxor1d(sets[0], sets[j]))


def test_jaccard_deals_large_tiles_and_groups_out(spark, monkeypatch):
    """Blocks of a few rows give the same components, and no task holds more than two of them."""
    rng = np.random.default_rng(12)
    lexicon = [f"w{i}" for i in range(500)]
    base = list(rng.choice(lexicon, 80))
    texts = {}
    for i in range(160):  # near copies in several sets, all with one long common line
        w = list(base) if i % 2 else list(rng.choice(lexicon, 80))
        for at in rng.integers(0, 80, int(rng.integers(0, 4))):
            w[at] = f"x{rng.integers(0, 9)}"
        texts[i] = " ".join(w) + " boilerplateboilerplate longlonglonglonglong linelinelinelineline"
    made = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    sets = {i: {tuple(w[k:k + 3]) for k in range(len(w) - 2)} for i, t in texts.items() for w in [words(t, True)]}
    want = groups_of(sets, 9, 10)
    whole = ngram_jaccard._spanning

    def spied(placed, load, mass, most, within, across):
        def bounded(kernel, blocks):
            def run(batches):
                import pyarrow as pa

                batches = list(batches)
                if batches:
                    sizes = pa.Table.from_batches(batches).group_by("grp").aggregate([("id", "count")]).column("id_count").to_pylist()
                    # blocks are dealt by hash, so one may hold some rows more than 8
                    if sizes and max(sizes) > 24 * blocks:
                        raise AssertionError(f"{max(sizes)} rows in one task")
                yield from kernel(iter(batches))
            return run
        return whole(placed, load, mass, most, bounded(within, 1), bounded(across, 2))

    monkeypatch.setattr(ngram_jaccard, "_spanning", spied)
    monkeypatch.setattr(ngram_jaccard, "TILE_BLOCK", 8)
    monkeypatch.setattr(ngram_jaccard, "GROUP_BLOCK", 8 * (ngram_jaccard.ROW_MASS + 81))
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.jaccard_components(made).collect()}
    assert got == want and len(set(want.values())) > 10


def test_substring_dedup(docs, rows):
    seen, want = set(), {}
    for doc_id, text, *_ in sorted(rows):
        w = words(text)
        runs = [tuple(w[p:p + 50]) for p in range(len(w) - 49)]
        gone = [False] * len(w)
        for p, run in enumerate(runs):
            if run in seen:
                gone[p:p + 50] = [True] * 50
        seen.update(runs)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[doc_id] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest(docs).collect()}
    assert got == want and want[14][1] == 70 and want[8][1] == 300
    cut = {r["doc_id"]: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert cut[8]["text"] == "" and cut[7]["text"] == rows[6][1] and cut[19]["text"] == rows[18][1] and len(cut) == len(rows)


def test_contamination(spark, docs, rows):
    items = [(1, rows[6][1][:200]), (2, "Two, WORDS!"), (3, None), (4, "..."), (10, rows[11][1][30:400]), (11, "never seen"),
             (12, rows[6][1][:200])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for item_id, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item_id))
    want = {}
    for doc_id, text, *_ in rows:
        w, hit, found = item_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i:i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want[doc_id] = (len(w), len(hit), len(found), sha, bool(hit))
    got = {r[0]: tuple(r)[1:] for r in contamination.report(docs, bench).collect()}
    assert got == want and want[6][4]
    assert {r["doc_id"] for r in contamination.clean(docs, bench).collect()} == {i for i, x in want.items() if not x[4]}


def test_proximity(spark, docs):
    near = spark.createDataFrame([(1, "one"), (2, "vertical tab"), (3, "tab nbsp"), (4, "absent one")], "phrase_id long, text string")
    got = {(r["phrase_id"], r["doc_id"]) for r in contamination.proximity_matches(docs, near, within=2).collect()}
    assert got == {(1, 4), (1, 5), (2, 19)}


def test_encoder_equals_the_library(rows):
    from netsleuth.llm import encode

    odd = [r[1] or "" for r in rows if r[0] != 17] + ["a  b", " lead", "trail ", "x\n\ny", "it's <|endoftext|>", "\x00mark", "Σ İ\u3000é"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        library = Tokenizer.from_file(public_tokenizers.path(name))
        small = encode.Encoder(public_tokenizers.path(name))
        for got, text in zip(small.encode(odd), odd):
            assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_packing(docs, rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=256).collect()
    by_doc, by_bin = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_bin.setdefault(p["sequence_id"], []).append(p)
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        mine = sorted(by_doc[doc_id], key=lambda p: p["start"])
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in mine]).tolist() == ids
        assert all(p["doc_tokens"] == len(ids) for p in mine)
    for members in by_bin.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 256
    for total in range(0, 9000, 7):
        assert sum(packing.cut_lengths(total, 4096, 64)) == total


def test_wavelet(spark, docs, rows):
    folder = shared.new_folder(spark, "tokens")
    path = public_tokenizers.path("byte_bpe_50k.json")
    wavelet.write_tokens(docs, path, folder)
    library, at, want, spots = Tokenizer.from_file(path), 0, {}, []
    for doc_id, text, *_ in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        spots += [(doc_id, i) for i, v in enumerate(ids) if v == 2]
        at += len(ids)
    assert {r[0]: tuple(r)[1:] for r in wavelet.read_tokens(spark, folder).collect()} == want
    assert sorted(tuple(r) for r in wavelet.find_token(spark, folder, 2).collect()) == spots
    ids = np.random.default_rng(2).integers(0, 37, 3000).astype("<u4") * 11
    m = wavelet.WaveletMatrix.build(ids)
    assert (m.all() == ids).all()
    for i in (0, 1, 511, 512, 513, 2999):
        assert m.access(i) == ids[i] and m.rank(22, i) == int((ids[:i] == 22).sum())
    assert (m.occurrences(33) == np.flatnonzero(ids == 33)).all() and m.select(33, 5) == np.flatnonzero(ids == 33)[5] and m.select(5, 0) == -1


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 4096, 20_000])
def test_wavelet_select(n, monkeypatch):
    """Every symbol's first, middle and last occurrence, without reading whole planes."""
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 300, n)).astype("<u4")
    m = wavelet.WaveletMatrix.build(ids)
    monkeypatch.setattr(wavelet.WaveletMatrix, "_bits", None)
    monkeypatch.setattr(wavelet.WaveletMatrix, "occurrences", None)
    for symbol in np.unique(ids).tolist():
        places = np.flatnonzero(ids == symbol)
        for k in {0, len(places) // 2, len(places) - 1}:
            assert m.select(symbol, k) == places[k] and m.rank(symbol, int(places[k])) == k
        assert m.select(symbol, len(places)) == -1 == m.select(symbol, -1)
    assert m.select(300, 0) == -1


def test_language_model(docs, rows):
    got = {r["doc_id"]: r for r in language_model.score_documents(docs).collect()}
    fold = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 for r in rows}
    tokens = {r[0]: words(r[1], True) + [None] for r in rows}
    count = Counter(t for i, ts in tokens.items() if fold[i] != 2 for t in ts)
    total, types = sum(count.values()), len(count)
    for i, ts in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (fold[i] == 2, len(ts), total)
        assert r["n_known"] == sum(count[t] > 0 for t in ts)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[t] + 1) / (total + types + 1)) for t in ts))
        assert -math.inf < r["score"] < 0
    seen = [r for r in got.values() if not r["held_out"]]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)


def mixture_scores(rows):
    """Scores of (doc_id, text, ...) rows from plain dictionaries; the weights are learnt on the same bins of events."""
    sequences = [(i, zlib.crc32(str(i).encode()) % 7, words(t, True) + [None]) for i, t, *_ in rows]
    parts = {0: (Counter(), Counter(), Counter()), 1: (Counter(), Counter(), Counter())}
    for _, fold, ts in sequences:
        if fold != 2:
            context, word, both = parts[int(fold == 5)]
            before = ["<start>"] + ts[:-1]
            context.update(before), word.update(ts), both.update(zip(before, ts))
    context, word, both = (parts[0][k] + parts[1][k] for k in range(3))
    types = len(word)
    # an estimate seen by the held-out part comes from the main part alone
    bins = {}
    for _, fold, ts in sequences:
        for b, t in zip(["<start>"] + ts[:-1], ts) if fold == 5 else ():
            seen = parts[0][0][b]
            p2, p1 = parts[0][2][b, t] / max(seen, 1), parts[0][1][t] / max(1, sum(parts[0][1].values()))
            key = (int(language_model._level(np.array(seen))), int(language_model._cell(np.array(p2))), int(language_model._cell(np.array(p1))))
            n, s2, s1 = bins.get(key, (0, 0.0, 0.0))
            bins[key] = (n + 1, s2 + p2, s1 + p1)
    events = np.array([(k[0], n, s2 / n, s1 / n) for k, (n, s2, s1) in bins.items()], dtype=float).reshape(-1, 4)
    weights = language_model.learn_weights(events, 1 / (types + 1))
    out = []
    for i, _, ts in sequences:
        score = 0.0
        for b, t in zip(["<start>"] + ts[:-1], ts):
            w = weights[min(context[b].bit_length(), language_model.LEVELS - 1)]
            score += math.log10(w[0] * both[b, t] / max(context[b], 1) + w[1] * word[t] / max(1, sum(word.values())) + w[2] / (types + 1))
        out.append((i, score))
    return sorted(out)


@pytest.mark.parametrize("batch", [language_model.BATCH, 700])
def test_language_model_scores_equal_plain_counts(spark, rows, monkeypatch, batch):
    """One batch a task and many; repeated rows, rows without text and without an id."""
    monkeypatch.setattr(language_model, "BATCH", batch)
    more = rows + rows[6:8] + [(None, "left out", None, None, None, "a", "b", None, 7)]
    table = spark.createDataFrame(more, SCHEMA).repartition(3)
    got = sorted((r["doc_id"], r["score"]) for r in language_model.score_documents(table).collect())
    want = mixture_scores([r for r in more if r[0] is not None])
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-9)


def test_mixture_weights_are_the_maximum():
    rng = np.random.default_rng(0)
    events = np.stack([np.full(50, 3.0), rng.integers(1, 90, 50).astype(float), rng.random(50) * (rng.random(50) < .5), rng.random(50) * .01], axis=1)
    w = language_model.learn_weights(events, 1e-4)[3]
    value = lambda v: (events[:, 1] * np.log(events[:, 2] * v[0] + events[:, 3] * v[1] + 1e-4 * v[2])).sum()
    assert w.sum() == pytest.approx(1) and all(value(w) >= value(v) - 0.1 for v in rng.dirichlet([1, 1, 1], 300))


def cosine_groups(vectors, bar=0.95):
    sets = {i: v for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    near = {i: [j for j in sets if j != i and len(sets[j]) == len(sets[i]) and np.dot(sets[i], sets[j]) >= bar * np.linalg.norm(sets[i]) * np.linalg.norm(sets[j])] for i in sets}
    out = {}
    for i, _ in vectors:
        reach, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        out[i] = (len(near.get(i, [])), min(reach), min(reach) == i)
    return out


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    vectors = [(i, (centres[i % 6] + rng.normal(size=8) * rng.choice([0.05, 0.3])).tolist()) for i in range(150)]
    vectors += [(200, None), (201, []), (202, [0.0] * 8), (203, [math.nan] + [1.0] * 7), (204, [None] + [1.0] * 7),
                (205, [math.inf] + [1.0] * 7), (206, [1.0, 2.0]), (207, [2.0, 4.0])] + [(300 + i, vectors[0][1]) for i in range(40)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<double>, label int, id string")
    got = {r[0]: tuple(r)[1:] for r in embedding_dedup.near_vectors(table, cells=5).collect()}
    assert got == cosine_groups(vectors)
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0
    asked = table.filter("vec_id % 20 = 0 and vec_id < 150")
    brute = {r[0]: r[1] for r in embedding_dedup.brute_force_links(table.filter("vec_id < 150 or vec_id >= 300"), asked).collect()}
    assert brute == {i: got[i][0] for i in brute}


def test_url_rules(spark):
    urls = [(1, None), (2, "no scheme"), (3, "http://A.Example.NET/en/1?x#y"), (4, "https://example.net/de/"), (5, "http://net/x"),
            (6, "http://xexample.com/de/1"), (7, "http://b.example.com/de/1"), (8, "http://b.example.com/en/1"), (9, "http://x.org"),
            (10, "http://x.org/fr/2"), (11, "a://b://c.net/d"), (12, "http://x.org?/fr/"), (12, "http://x.org?/fr/")]
    pages = spark.createDataFrame([(i, u, "h", "n") for i, u in urls], "page_id long, url string, host string, node string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert [got[i][:3] for i in range(1, 13)] == [
        ("", "", None), ("", "", None), ("a.example.net", "/en/1", "example.net/en/"), ("example.net", "/de/", "net/"), ("net", "/x", "net/"),
        ("xexample.com", "/de/1", None), ("b.example.com", "/de/1", "example.com/de/"), ("b.example.com", "/en/1", None), ("x.org", "", None),
        ("x.org", "/fr/2", "org/fr/"), ("b:", "//c.net/d", None), ("x.org", "", None)]
    assert got[3][3] == "allow" and got[4][3] == "block" and got[7][3] == "block" and all(v[3] in ("allow", "block") for v in got.values())
    assert url_filter.judge(pages).count() == len(urls) and url_filter.judge(pages.limit(0)).count() == 0


def test_url_templates_learn_from_labels(spark):
    urls = [(i, f"http://h.example.net/{'en' if i % 2 else 'de'}/{i}") for i in range(60)]
    urls += [(100 + i, f"http://k.example.org/{'en' if i % 2 else 'de'}/{i}") for i in range(10)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert all(got[100 + i] == ("allow" if i % 2 else "block") for i in range(10))


def plain_verdicts(urls, rules):
    """Verdicts of (id, host, path) by recursion over plain lists."""
    def rule(host, path):
        fit = [(len(h + p), h, p, k) for k, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[3] if fit else None

    def name(paths, parent, nodes):
        kinds = Counter(segs[0] for _, segs in paths)
        wild = len(kinds) > url_filter.MANY and len(paths) < len(kinds) * url_filter.MANY
        groups = {}
        for path, segs in paths:
            groups.setdefault(parent + "/" + ("*" if wild else segs[0]), []).append((path, segs[1:]))
        for node, group in groups.items():
            for path, _ in group:
                nodes[path].append(node)
            open_ = [(path, segs) for path, segs in group if segs]
            if len(open_) > url_filter.MANY:
                name(open_, node, nodes)
            else:
                for path, segs in open_:
                    nodes[path] += [node + "/" + "/".join(segs[:i + 1]) for i in range(len(segs))]

    tree = {}
    for host in {h for _, h, _ in urls}:
        paths = sorted({p for _, h, p in urls if h == host})
        segs = {p: [s for s in re.sub("[0-9]+", "<n>", p).split("/") if s] for p in paths}
        tree[host] = {p: [""] for p in paths}
        name([(p, segs[p]) for p in paths if segs[p]], "", tree[host])
    own, wide = {}, {}
    for _, host, path in urls:
        verdict = rule(host, path)
        for node in tree[host][path] if verdict else ():
            for table, key in ((own, (host, node)), (wide, node)):
                n, b = table.get(key, (0, 0))
                table[key] = (n + 1, b + (verdict == "block"))

    def anywhere(node):
        parts, p = node.split("/"), 0.5
        for i in range(len(parts)):
            n, b = wide["/".join(parts[:i + 1])]
            p = (b + url_filter.SMOOTHING * p) / (n + url_filter.SMOOTHING)
        return p

    def purity(host, node):
        if (host, node) not in own:
            return anywhere(node) if node in wide else None
        (n, b), (big_n, big_b) = own[host, node], own.get((host, node.rpartition("/")[0]), (0, 0)) if node else (0, 0)
        if big_n:
            share = big_b / big_n
            if abs(b / n - share) / math.sqrt(max(share * (1 - share), 0.01) / n) < url_filter.SIGNIFICANT:
                n, b = big_n, big_b
        return (b + url_filter.SMOOTHING * anywhere(node)) / (n + url_filter.SMOOTHING)

    out = []
    for i, host, path in urls:
        found = [p for p in (purity(host, node) for node in tree[host][path]) if p is not None]
        out.append((i, rule(host, path) or ("block" if found and found[-1] >= 0.5 else "allow")))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_url_verdicts_equal_plain_recursion(spark, seed):
    """Random trees with wide and narrow levels, labels that differ by branch, repeated and empty urls."""
    rng = np.random.default_rng(seed)
    rules = [("block", "net", "/ads/"), ("allow", "net", "/ads/ok/"), ("allow", "net", "/news/"), ("block", "net", "/x/b")]
    pick = lambda *kinds: str(rng.choice(kinds))
    urls = []
    for i in range(900):
        host = pick("a.net", "b.net", "c.org", "d.org", "d.org")
        path = "/" + "/".join([pick("ads", "news", "x", "y"), pick("ok", "b", "c", f"u{rng.choice(list('abcdefghijklmnopqrstuvwxyz'))}"),
                               pick("p", "q", f"{rng.integers(1000)}"), pick("z", "end", "w" * int(rng.integers(1, 40)))][:int(rng.integers(0, 5))])
        urls.append((i, host, path))
    urls += [(i + 2000, h, p) for i, h, p in urls[::7]] + [(5000, "a.net", "")]
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, h, p in urls], "page_id long, url string").repartition(4)
    got = sorted((r["page_id"], r["verdict"]) for r in url_filter.judge(pages, rules).collect())
    assert got == plain_verdicts(urls, rules) and {v for _, v in got} == {"allow", "block"}


def test_url_templates_cover_whole_paths(spark):
    rules = [("block", "x.com", "/a/b/c/d/ads/"), ("allow", "x.com", "/a/b/c/d/docs/")]
    kind = lambda i: "docs" if i % 2 else "ads"
    urls = [(i, f"http://x.com/a/b/c/d/{kind(i)}/{i}") for i in range(60)]
    urls += [(100 + i, f"http://y.com/a/b/c/d/{kind(i)}/p{i}/q") for i in range(60)]
    urls += [(200, "http://z.com/" + "s/" * 300)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()}
    assert all(got[100 + i] == ("allow" if i % 2 else "block") for i in range(60)) and len(got) == len(urls)
    made = spark.createDataFrame([("h", "/1/2/3/4/5/" + "abcdefghijklmnopqrstuvwxy"[i] + "/end") for i in range(25)], "host string, path string")
    assert {tuple(r["nodes"][-2:]) for r in url_filter.templates(made).collect()} == {
        ("/<n>/<n>/<n>/<n>/<n>/*", "/<n>/<n>/<n>/<n>/<n>/*/end")}


def test_url_templates_do_not_depend_on_the_number_of_rows(spark):
    made = spark.createDataFrame([("h", "/" + "abcdefghijklmnopqrstuvwxy"[i] + "/end") for i in range(25)], "host string, path string")
    again = made.crossJoin(spark.range(30)).select("host", "path")
    nodes = lambda df: {(r["path"], tuple(r["nodes"])) for r in url_filter.templates(df).collect()}
    assert nodes(again) == nodes(made) == {(r["path"], ("", "/*", "/*/end")) for r in made.collect()}


def test_toxicity_and_quality(spark):
    rng = np.random.default_rng(9)
    lexicon = [f"word{i}" for i in range(300)]
    made = []
    for i in range(600):
        text, toxic, good = list(rng.choice(lexicon, 60)), i % 4 == 0, i % 3 != 0
        if toxic:
            for at in rng.integers(0, 60, 3):
                text[at] = f"slur{rng.integers(0, 5)}"
        if not good:
            text = [t + "$$" for t in text]
        made.append((i, " ".join(text), int(good), int(toxic)))
    made += [(1000, None, 1, 0), (1001, "", 1, 0)]
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(m[0], m[2], m[3]) for m in made], "doc_id long, quality int, toxic int")
    held = {m[0]: m for m in made if zlib.crc32(str(m[0]).encode()) % 5 == 0 and m[0] < 1000}
    toxic = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    good = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, labels).collect()}
    assert len(toxic) == len(good) == len(made) and all(0 <= s <= 1 for s in [*toxic.values(), *good.values()])
    right = lambda scores, at, bar: np.mean([(scores[i] >= bar) == bool(m[at]) for i, m in held.items()])
    assert right(toxic, 3, 0.5) > 0.95 and right(good, 2, 0.3) > 0.95


def test_scores_without_usable_labels(docs, labels, rows):
    none = labels.limit(0)
    for scored in (toxicity.score_toxicity(docs, none), quality.score_quality(docs, none), toxicity.score_toxicity(docs, labels),
                   quality.score_quality(docs, labels)):
        got = scored.select("doc_id", "score").collect()
        assert sorted(r[0] for r in got) == [r[0] for r in rows] and all(0 <= r[1] <= 1 for r in got)


def test_repeated_rows(spark):
    twice = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "other text"), (2, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert sorted((r[0], r[3]) for r in ngram_jaccard.jaccard_components(twice).collect()) == [(1, 1)] * 3 + [(2, 1)]
    assert substring_dedup.digest(twice).count() == 4
    assert ngram_jaccard.keep_one(twice).count() == 4
    assert sorted(r["n_tokens"] for r in language_model.score_documents(twice).collect()) == [3, 5, 5, 5]


def test_empty_tables(spark, empty, labels):
    bench = spark.createDataFrame([], "item_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = shared.new_folder(spark, "tokens")
    wavelet.write_tokens(empty, path, folder)
    for df in (ngram_jaccard.jaccard_components(empty), substring_dedup.digest(empty), contamination.report(empty, bench),
               packing.pack(empty, path), wavelet.read_tokens(spark, folder), language_model.score_documents(empty),
               toxicity.score_toxicity(empty, labels), quality.score_quality(empty, labels)):
        assert df.count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        kept[name] = shared.written(after)
        docs = kept[name]
    sets = {r["doc_id"]: {tuple(w[i:i + 5]) for w in [words(r["text"], True)] for i in range(max(1, len(w) - 4))} if words(r["text"]) else set()
            for r in kept["toxicity"].collect()}
    groups = groups_of(sets, 8, 10)
    assert {r["doc_id"] for r in kept["near_copies"].collect()} == {i for i, g in groups.items() if i == g}
    texts = {name: {r["doc_id"]: r["text"] for r in df.collect()} for name, df in kept.items()}
    # repeats: words of 50-word windows that a smaller id also starts
    first, left = {}, {}
    split = {i: words(t) for i, t in texts["near_copies"].items()}
    for i in sorted(split):
        for k in range(len(split[i]) - 49):
            first.setdefault(tuple(split[i][k:k + 50]), i)
    for i, w in split.items():
        gone = {p for k in range(len(w) - 49) if first[tuple(w[k:k + 50])] < i for p in range(k, k + 50)}
        left[i] = [x for k, x in enumerate(w) if k not in gone]
    assert {i: words(t) for i, t in texts["substring_dedup"].items()} == left
    # benchmark passages: no window of ten words, or of a whole shorter item, is left
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = item_words(r["text"])
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    holds = lambda w: any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    assert set(texts["decontamination"]) == {i for i, t in texts["substring_dedup"].items() if not holds(item_words(t))}
    pieces = corpus_pipeline.run(spark, FOLDER)
    library, packed, filled = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}, {}
    for r in pieces.orderBy("doc_id", "start").collect():
        packed[r["doc_id"]] = packed.get(r["doc_id"], b"") + bytes(r["ids"])
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert packed == {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes()
                      for i, t in texts["decontamination"].items()}
    for spans in filled.values():
        assert sum(n for _, n in spans) <= 4096
        assert [at for at, _ in sorted(spans)] == np.cumsum([0, *[n for _, n in sorted(spans)]])[:-1].tolist()


def test_pipeline_stages_on_rows_without_values(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "no id", None, None, None), (1, None, None, None, None), (2, "", None, None, 0), (3, "one two", "en", None, 7),
            (3, "one two", "en", None, 7), (4, "word " * 5000, None, "s", 25000)]
    docs = spark.createDataFrame(rows, schema)
    for made, want in ((docs, {1, 2, 3, 4}), (docs.limit(0), set())):
        for name, stage in corpus_pipeline.STAGES:
            made = shared.written(stage(spark, made, FOLDER), name)
        assert {r["doc_id"] for r in made.select("doc_id").collect()} == want


def test_components(spark):
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 400)] + [(500, i) for i in range(501, 560)]
    got = {r["id"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert all(got.get(i, i) == r for i, r in root.items())
