"""Main text of pages, periodic runs and token alignment against brute force, with nulls, empties, repeats and clashing columns."""

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from netsleuth.llm import html_blocks, main_text, page_samples, periodic_runs, token_alignment
from netsleuth.llm.words import mix

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# main text

@pytest.fixture(scope="module")
def tree():
    return main_text.train_tree()


def test_tree_fits_its_labelled_table(tree):
    rows, kept = page_samples.labelled_blocks()
    assert ((tree.share_of(np.array(rows, float)) >= 0.5) == np.array(kept, bool)).all()
    assert 0.2 < np.mean(kept) < 0.8


def test_tree_splits_where_gini_falls_most():
    rng = np.random.default_rng(5)
    rows, kept = rng.integers(0, 6, (60, 3)).astype(float), rng.integers(0, 2, 60).astype(float)
    impurity = lambda y: len(y) * y.mean() * (1 - y.mean()) if len(y) else 0.0
    want = max((impurity(kept) - impurity(kept[low]) - impurity(kept[~low]), -f, -t)
               for f in range(3) for t in np.arange(0.5, 5.5) for low in [rows[:, f] <= t]
               if main_text.LEAF <= low.sum() <= 60 - main_text.LEAF)
    gain, feature, threshold = main_text._best_split(rows, kept)
    assert gain == pytest.approx(want[0]) and feature == -want[1] and threshold == -want[2]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n ", ""), ("<html><body></body></html>", ""),
    ("<p>Only &lt;text&gt; a&nbsp;b</p>", "Only <text> a b"),
    ("plain text without tags", "plain text without tags"),
    ("<article><h1>T</h1><p>A<b>b</b>c<br>d<script>if(a<b){}</script> e &amp;amp; f <!-- x > --> g < h </article><footer>f</footer>",
     "T\n\nAbc d e &amp; f g < h"),
    ("<article>unclosed <p>one<p>two<div class='advert'>buy</div><p>three <a href='x>y'>link</a> four", "unclosed\n\none\n\ntwo\n\nthree link four"),
    ("<div id=main-menu><a href=/>Home</a></div><div class=content-with-sidebar><h1>Title</h1><p>A paragraph of the main article.</p>"
     "<p>Short.</p><div class=comments><p>Nice post I liked it very much</p></div></div>", "Title\n\nA paragraph of the main article.\n\nShort."),
    ("<body><div class='cookie-notice'>We use cookies here</div><main><h1>Hi</h1><p>one</p><p>two</p></main><div class='site-footer'>(c)</div>",
     "Hi\n\none\n\ntwo"),
    ("<article><header><h1>Head</h1><p>By me</p></header><p>Body of it all.</p><form><p>Send</p></form></article>", "Head\n\nBody of it all."),
    ("<title>no end", ""), ("<a <a <a", ""), ("<script>x", ""), ("a <!-- never closed", "a"),
    ("<style>p</style><svg><text>x</text></svg><article>y &copy; &#x41;&#65;</article>", "y © AA"),
])
def test_pages_of_many_kinds(tree, page, text):
    assert main_text.main_text(page, tree) == text


@pytest.mark.parametrize("page", [
    "<a " * 200_000, "<div>" * 50_000 + "x", "<li><div>" * 30_000, "<div class=ad>" * 30_000 + "x", '="' * 200_000,
    '<p title="' * 50_000, "<!--" * 200_000, "&" * 300_000, "<span></b>" * 50_000])
def test_odd_pages_take_time_in_proportion(tree, page):
    import time

    start = time.time()
    main_text.main_text(page, tree)
    assert time.time() - start < 10


def plain_article(page):
    """The blocks of a page of the given tables, whose text lies in one ``article``."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner.group(1)) if inner else []
    said = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n\n".join(b for b in said if b)


def test_main_text_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {r["page_id"]: (r["url"], plain_article(r["html"])) for r in pages.collect()}
    got = entry.queries()["op11_main_text"](spark, FOLDER).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == len(want)


def test_main_text_of_rows_without_values(spark, tree):
    schema = "page_id long, url string, html string, text string, n_chars string"
    made = spark.createDataFrame([(None, None, None, "x", "y"), (1, "u", "<p>a</p>", None, None), (1, "u", "<p>a</p>", "b", "c")], schema)
    got = sorted(map(tuple, main_text.extract(made, tree).collect()), key=str)
    assert got == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert main_text.extract(made.limit(0), tree).count() == 0


# periodic runs

def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_digest(doc_id, words):
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_transform_is_a_convolution():
    rng = np.random.default_rng(2)
    for n in (2, 8, 64):
        x, y = (rng.integers(0, periodic_runs.P, (n, 3)).astype(np.uint64) for _ in range(2))
        got = periodic_runs.inverse(periodic_runs._mul(periodic_runs.forward(x), periodic_runs.forward(y)))
        want = [[sum(int(x[j, c]) * int(y[(i - j) % n, c]) for j in range(n)) % periodic_runs.P for c in range(3)] for i in range(n)]
        assert got.tolist() == want


def test_occurrences_are_the_blocks_that_come_back():
    rng = np.random.default_rng(3)
    line = rng.integers(0, 2, 400)
    values = mix(line.astype(np.uint64)) % np.uint64(periodic_runs.P)
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(periodic_runs._mul(values, values))])
    for size in (8, 16):
        at = np.arange(0, 300, size)
        got = set(zip(*(v.tolist() for v in periodic_runs.occurrences(values, squares, at, size))))
        assert got == {(i, d) for i in at.tolist() for d in range(1, 2 * size) if (line[i:i + size] == line[i + d:i + d + size]).all()}


def test_runs_of_many_lines():
    rng = np.random.default_rng(1)
    for turn in range(250):
        k, n = int(rng.integers(1, 6)), int(rng.integers(0, 260))
        line = [lambda: rng.integers(0, k, n),
                lambda: np.tile(rng.integers(0, k, int(rng.integers(1, 50))), 200)[:n],
                lambda: np.concatenate([np.tile(rng.integers(0, k + 1, int(rng.integers(1, 30))), int(rng.integers(1, 9))) for _ in range(6)]),
                lambda: np.tile(np.r_[np.zeros(int(rng.integers(3, 60)), int), 1], int(rng.integers(2, 6)))][turn % 4]()
        got = periodic_runs.find_runs(mix(line.astype(np.uint64) + np.uint64(9)), len(line))
        assert list(map(tuple, got.tolist())) == brute_runs(line.tolist())


def test_a_hash_that_lies_is_found_out():
    line = np.tile(mix(np.arange(10, dtype=np.uint64)), 6)
    line[33] = 5
    words = mix(line)
    want = [tuple(r) for r in brute_runs(words.tolist())]
    reach = periodic_runs._Reach.equal
    try:
        periodic_runs._Reach.equal = lambda self, at, length, distance: np.ones(len(at), bool)
        lying = periodic_runs.find_runs(words, len(words))
    finally:
        periodic_runs._Reach.equal = reach
    assert set(map(tuple, lying.tolist())) <= set(want)


@pytest.fixture(scope="module")
def run_rows():
    rng = np.random.default_rng(8)
    lexicon = [f"w{i}é" for i in range(60)]
    prose = lambda n: " ".join(rng.choice(lexicon, n))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "spam " * 23), (5, "spam " * 24), (6, "a b\n" * 500 + "tail"), (6, "a b\n" * 500 + "tail"),
            (7, (prose(30) + " ") * 4), (8, prose(3000)), (9, "x" * 100_000), (10, "tab\tand\x0bvertical     " * 12)]
    return rows + [(i, prose(int(rng.integers(1, 400)))) for i in range(11, 120)]


def test_periodic_runs(spark, run_rows):
    schema = "doc_id long, text string, runs string, kept_text int, n_words int"
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in run_rows] + [(None, "a " * 50, "x", 1, 2)], schema).repartition(3)
    found = periodic_runs.periodic_runs(docs)
    split = lambda t: [w.decode() for w in WORDS.findall((t or "").encode())]
    want = sorted((i, len(split(t)), brute_runs(split(t))) for i, t in run_rows)
    assert sorted((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]]) for r in found.collect()) == want
    # the registered query's own planting and digest
    got = sorted(map(tuple, periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.plant_runs(docs))).collect()), key=str)
    assert got == sorted((brute_digest(i, planted(i, WORDS.findall((t or "").encode()))) for i, t in run_rows), key=str)
    assert sum(r[1] > 0 for r in got) > 10
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_op12_over_a_whole_table(spark):
    docs = [(r["doc_id"], planted(r["doc_id"], WORDS.findall((r["text"] or "").encode())))
            for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    # brute force over every period is quadratic; the longest texts are left to the lines above
    short = {i: w for i, w in docs if len(w) <= 1500}
    got = entry.queries()["op12_periodic_runs"](spark, FOLDER).collect()
    assert len(got) == len(docs) and len(short) > 0.8 * len(docs)
    for r in got:
        if r["doc_id"] in short:
            assert tuple(r) == brute_digest(r["doc_id"], short[r["doc_id"]])


# token alignment

def test_gallop_meets_every_common_end():
    rng = np.random.default_rng(6)
    for _ in range(60):
        texts = [(np.unique(rng.integers(1, m, n)), np.unique(rng.integers(1, m, k)))
                 for m, n, k in zip(rng.integers(2, 3000, 5), rng.integers(0, 1200, 5), rng.integers(0, 1200, 5))]
        a, b = (np.concatenate([t[i] for t in texts]) for i in (0, 1))
        first = [np.concatenate([[0], np.cumsum([len(t[i]) for t in texts])]) for i in (0, 1)]
        in_a, in_b = token_alignment.common_ends(a, first[0], b, first[1])
        want = [(i + first[0][t], j + first[1][t]) for t, (x, y) in enumerate(texts) for v in np.intersect1d(x, y)
                for i, j in [(int(np.searchsorted(x, v)), int(np.searchsorted(y, v)))]]
        assert list(zip(in_a.tolist(), in_b.tolist())) == want


def brute_alignment(rows):
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    spelled = []
    for doc_id, text in rows:
        out = []
        if text:
            want = (" " + text).encode()
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            said_a = [token_alignment.byte_level_bytes(a_lib.id_to_token(i)) for i in a]
            said_b = [token_alignment.piece_bytes(b_lib.id_to_piece(i)) for i in b]
            if b"".join(said_a) == want == b"".join(said_b):
                ends = [dict(zip(np.cumsum([len(s) for s in said]).tolist(), range(1, len(said) + 1))) for said in (said_a, said_b)]
                i = j = 0
                for end in sorted(ends[0].keys() & ends[1].keys()):
                    out.append((a[i:ends[0][end]], b[j:ends[1][end]]))
                    i, j = ends[0][end], ends[1][end]
        spelled.append((doc_id, out))
    links = [[(x, y) for xs, ys in out for x in xs for y in ys] for _, out in spelled]
    counts = Counter(pair for each in links for pair in set(each))
    most = defaultdict(int)
    for (x, _), c in counts.items():
        most[x] = max(most[x], c)
    return sorted((
        doc_id, sum(len(x) for x, _ in out), sum(len(y) for _, y in out), len(out), len(each),
        sum(counts[p] == most[p[0]] for p in each), sum(counts[p] for p in each),
        sha(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in out)) if out else "")
        for (doc_id, out), each in zip(spelled, links))


@pytest.fixture(scope="module")
def align_rows():
    rng = np.random.default_rng(9)
    letters = list("abcdefgh éüß漢字😀  \n\t'.,-0123456789<|>")
    rows = [(1, None), (2, ""), (3, " "), (4, "<|endoftext|> <s> </s> <unk> <0x41>"), (5, "▁x"), (6, "a  b\n\n c\r\n"), (7, "\x00 z"),
            (8, " lead"), (9, "日本語 テキスト 😀😀"), (10, "x" * 3000), (11, "same text here"), (11, "same text here"), (12, "same text here"),
            (13, "ab " * 20_000)]
    return rows + [(i, "".join(rng.choice(letters, int(rng.integers(1, 400))))) for i in range(14, 90)]


def test_alignment_of_odd_texts(spark, align_rows, monkeypatch):
    monkeypatch.setattr(token_alignment, "HOT_SHARE", 40)
    schema = "doc_id long, text string, pair int, batch int, n_a string"
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in align_rows] + [(None, "a b", 1, 2, "x")], schema).repartition(3)
    got = sorted(map(tuple, token_alignment.alignment(docs, A, B).collect()))
    assert got == brute_alignment(align_rows)
    assert token_alignment.alignment(docs.limit(0), A, B).count() == 0


def test_rows_of_batches_are_written_one_by_one(spark):
    """However many batches a task writes, neither its writer nor a reader holds more than one of them."""
    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, "ab " * 1_400_000) for i in range(2)], "doc_id long, text string").coalesce(1)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in token_alignment.align(docs, A, B).inputFiles()]
    sizes = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert len(files) == 1 and sizes == [1, 1]


def test_op13_over_a_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = entry.queries()["op13_token_alignment"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == brute_alignment(rows)


def test_links_are_expanded_in_bounded_parts(monkeypatch):
    pair = token_alignment._pair(A, B)
    texts = ["one two three", "ßßß漢字 " * 40]

    def links():
        ids_a, ids_b, end_a, end_b, first, _, _ = token_alignment.groups(pair, texts)
        row = np.repeat(np.arange(2), np.diff(first))
        return [v.tolist() for v in token_alignment._links(pair, ids_a, ids_b, end_a, end_b, row, 2)]

    whole = links()
    monkeypatch.setattr(token_alignment, "LINKS", 3)
    assert links() == whole


def test_blocks_of_a_page_in_order():
    blocks = html_blocks.text_blocks("<ul><li>a <a href=#>b c</a><li>d</ul><h2>e</h2>f")
    assert [(b.text, b.words, b.link_words, b.heading) for b in blocks] == [("a b c", 3, 2, False), ("d", 1, 0, False), ("e", 1, 0, True), ("f", 1, 0, False)]
