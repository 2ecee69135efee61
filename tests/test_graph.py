"""Graph build, splits, negatives, message passing and ranking on small graphs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from netsleuth.functions.schema import BUNDLE_OBJECT
from netsleuth.operators import graph, links
from netsleuth.sources import io

BUNDLE = """{"objects": [
 {"type": "attack-pattern", "id": "attack-pattern--1", "name": "Phishing",
  "external_references": [{"source_name": "x", "external_id": "no"}, {"source_name": "mitre-attack", "external_id": "T1566"}]},
 {"type": "attack-pattern", "id": "attack-pattern--2", "name": "Spear",
  "external_references": [{"source_name": "mitre-attack", "external_id": "T1566.001"}]},
 {"type": "attack-pattern", "id": "attack-pattern--3", "name": "Old", "x_mitre_deprecated": true},
 {"type": "intrusion-set", "id": "intrusion-set--1", "name": "APT One"},
 {"type": "malware", "id": "malware--1", "name": "Bad"},
 {"type": "relationship", "relationship_type": "uses", "source_ref": "intrusion-set--1", "target_ref": "attack-pattern--1"},
 {"type": "relationship", "relationship_type": "uses", "source_ref": "malware--1", "target_ref": "attack-pattern--1"},
 {"type": "relationship", "relationship_type": "uses", "source_ref": "intrusion-set--1", "target_ref": "malware--1"},
 {"type": "relationship", "relationship_type": "uses", "source_ref": "intrusion-set--1", "target_ref": "attack-pattern--3"},
 {"type": "relationship", "relationship_type": "uses", "source_ref": "malware--1", "target_ref": "attack-pattern--2", "revoked": true},
 {"type": "relationship", "relationship_type": "subtechnique-of", "source_ref": "attack-pattern--2", "target_ref": "attack-pattern--1"}
]}"""


def test_build_graph_from_bundle(spark, tmp_path):
    (tmp_path / "bundle.json").write_text(BUNDLE)
    objects = io.read_bundle(spark, str(tmp_path / "bundle.json"))
    nodes = graph.graph_nodes(objects)
    assert {(r["kind"], r["ext_id"]) for r in nodes.collect()} == {
        ("technique", "T1566"), ("technique", "T1566.001"), ("group", ""), ("software", "")}
    edges = graph.graph_edges(objects.filter("type = 'relationship'"), nodes)
    counts = {r["what"]: r["n"] for r in graph.graph_counts(nodes, edges).collect()}
    assert counts == {"technique": 2, "group": 1, "software": 1, "group_uses_technique": 1,
                      "software_uses_technique": 1, "group_uses_software": 1, "subtechnique_of": 1}
    index = graph.dense_index(nodes).select("idx").collect()
    assert sorted(r[0] for r in index) == [0, 1, 2, 3]


def typed(spark, groups, techniques):
    rows = [(f"g{i}", "group") for i in range(groups)] + [(f"t{i}", "technique") for i in range(techniques)]
    return spark.createDataFrame([(i, k, i.upper(), i if k == "technique" else "") for i, k in rows],
                                 "id string, kind string, name string, ext_id string")


@pytest.mark.parametrize("groups,techniques,wanted", [(384, 427, 427), (64, 64, 500), (5, 9, 12), (5, 9, 100), (1, 1, 3), (3, 1, 2)])
def test_negatives_are_a_random_draw_of_what_is_no_edge(spark, groups, techniques, wanted):
    edges = {(f"g{g}", f"t{t}") for g in range(groups) for t in range(techniques) if (3 * g + 5 * t) % 7 == 0}
    free = groups * techniques - len(edges)
    known = spark.createDataFrame(sorted(edges), "src string, dst string")
    draw = lambda seed: [tuple(r) for r in graph.sample_negatives(typed(spark, groups, techniques), known, wanted, seed).collect()]
    found = draw(42)
    assert len(found) == min(wanted, free) and len(set(found)) == len(found) and not set(found) & edges
    assert sorted(found) == sorted(draw(42))
    if len(found) < free:
        for side, size in ((0, groups), (1, techniques)):
            # counts of a side's members are about Poisson: their number and their largest lie where a shuffle's would
            each = Counter(pair[side] for pair in found)
            mean = len(found) / size
            expected = size * (1 - (1 - 1 / size) ** len(found))
            assert abs(len(each) - expected) <= 5 * expected ** 0.5 / 2 + 1
            assert max(each.values()) <= mean + 5 * mean ** 0.5 + 3
        other = draw(43)
        # another seed is no shift of this one
        assert len(set(found) & set(other)) <= len(found) * len(found) / free + 5 * (len(found) ** 2 / free) ** 0.5 + 3


def test_keyed_permutation_visits_every_number_once(spark):
    for half, seed in ((1, 1), (3, 42), (6, 43)):
        codes = [r[0] for r in spark.range(1 << (2 * half)).select(graph.permuted(F.col("id"), half, seed)).collect()]
        assert sorted(codes) == list(range(1 << (2 * half)))


def test_no_ranking_without_a_vector(spark):
    z = spark.createDataFrame([("t0", [0.2])], "id string, z array<double>")
    known = spark.createDataFrame([], "src string, dst string")
    assert links.rank_techniques(typed(spark, 1, 1), z, known, "g0").count() == 0
    assert links.rank_techniques(typed(spark, 1, 1), z, known, None).count() == 0


def test_undirected_and_leak(spark):
    edges = spark.createDataFrame([(f"g{i}", f"t{i}", "group_uses_technique") for i in range(20)] + [("s0", "t0", "software_uses_technique")],
                                  "src string, dst string, rel string")
    once = [(r["src"], r["dst"]) for r in edges.collect()]
    both = [tuple(r) for r in graph.undirected(edges.select("src", "dst")).collect()]
    assert sorted(both) == sorted(once + [(b, a) for a, b in once])
    split = graph.target_split(edges, 0.1, 0.1)
    message = graph.message_edges(edges, split)
    assert graph.leaked_edges(message, split).count() == 0 and message.count() == 2 * (16 + 1)


def test_neighbour_mean(spark):
    x = spark.createDataFrame([("a", 0.0), ("b", 4.0), ("c", 8.0), ("lone", 5.0)], "id string, f double")
    m = graph.undirected(spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string"))
    got = {r["id"]: r["f"] for r in graph.neighbour_mean(x, m, ["f"], hops=1).collect()}
    assert got == {"a": 2.0, "b": 4.0, "c": 6.0, "lone": 5.0}


def test_edges_in_tiles(spark, monkeypatch):
    """Small tiles, a hub, repeated nodes and relations, nulls, unknown ids and types against a plain double loop."""
    import random

    monkeypatch.setattr(graph, "BLOCK_NODES", 5)
    monkeypatch.setattr(graph, "ROW_EDGES", 7)
    monkeypatch.setattr(graph, "CHUNK_EDGES", 4)
    rng = random.Random(8)
    kinds = ["technique", "group", "software", None]
    nodes = [(f"n{i}", kinds[i % 4]) for i in range(24)] + [("n1", "group"), ("n2", "technique"), (None, "group")]
    pick = lambda: rng.choice([f"n{i}" for i in range(26)] + [None])
    told = [(rng.choice(["uses", "uses", "subtechnique-of", "other", None]), pick(), pick()) for _ in range(300)]
    told += [("uses", "n5", f"n{i}") for i in range(24)] * 2
    want = [(s, d, graph.RELATIONS[k, ks, kd]) for k, s, d in told for i, ks in nodes for j, kd in nodes
            if s is not None and d is not None and s == i and d == j and (k, ks, kd) in graph.RELATIONS]
    relations = spark.createDataFrame([(*r, None, None) for r in told], "relationship_type string, source_ref string, "
                                      "target_ref string, revoked boolean, x_mitre_deprecated boolean")
    found = graph.graph_edges(relations, spark.createDataFrame(nodes, "id string, kind string"))
    assert found.columns == ["src", "dst", "rel"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want) and len(want) > 40


def test_hops_leave_the_edges_where_they_lie(spark, monkeypatch):
    """Only values of nodes are shuffled to the tiles, neither side of a tile is dealt out anew."""
    plans, plain = [], graph.durable

    def durable(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *more)

    monkeypatch.setattr(graph, "durable", durable)
    monkeypatch.setattr(graph, "BLOCK_NODES", 10)
    x = spark.createDataFrame([(f"n{i}", float(i)) for i in range(30)], "id string, f double")
    m = spark.createDataFrame([(f"n{i}", f"n{i * 7 % 30}") for i in range(30)], "src string, dst string")
    assert graph.neighbour_mean(x, m, ["f"], hops=1).count() == 30
    (hop,) = [p for p in plans if "CoGroup" in p]
    below = hop[hop.index("CoGroup"):].split("Scan ExistingRDD")[0]
    assert "Exchange" not in below and "Exchange" in hop


def test_neighbour_mean_in_tiles(spark, monkeypatch):
    """Small blocks and tiles, a hub, repeated edges and nodes, nulls and unknown ids against plain sums."""
    import random

    monkeypatch.setattr(graph, "BLOCK_NODES", 7)
    monkeypatch.setattr(graph, "TILE_EDGES", 9)
    monkeypatch.setattr(graph, "CHUNK_EDGES", 5)
    rng = random.Random(4)
    rows = [(f"n{i}", float(i) if i % 4 else None, i) for i in range(30)] + [("n3", 50.0, 2), (None, 1.0, 1)]
    once = [(f"n{rng.randint(0, 29)}", f"n{rng.randint(0, 29)}") for _ in range(60)] + [("n1", f"n{i}") for i in range(28)]
    once += [("n5", "n6"), ("n5", "n6"), ("n7", "n7"), ("n8", "gone"), ("gone", "n9"), (None, "n2"), ("n2", None)]
    x = spark.createDataFrame(rows, "id string, f double, g int")
    for mirrored in (False, True):
        sends = once + [(b, a) for a, b in once] if mirrored else once
        state = [tuple(r) for r in rows]
        for _ in range(2):
            got = {}
            for a, b in sends:
                for key, f, g in state:
                    if a is not None and b is not None and key == a:
                        got.setdefault(b, []).append((f, g))
            mean = lambda key, i, own: (lambda v: sum(v) / len(v) if v else own)([m[i] for m in got.get(key, []) if m[i] is not None])
            blend = lambda key, i, own: None if own is None else (own + mean(key, i, own)) / 2
            state = [(k, blend(k, 0, f), blend(k, 1, g)) for k, f, g in state]
        found = graph.neighbour_mean(x, spark.createDataFrame(once, "src string, dst string"), ["f", "g"], mirrored=mirrored)
        order = lambda r: str(r[0]) + str(r[2])
        for mine, want in zip(sorted((tuple(r) for r in found.collect()), key=order), sorted(state, key=order), strict=True):
            assert mine == (want[0], pytest.approx(want[1]), pytest.approx(want[2]))


def test_heuristics_against_brute_force(spark):
    import math
    import random

    rng = random.Random(5)
    once = {(f"g{rng.randint(0, 5)}", f"t{rng.randint(0, 8)}") for _ in range(30)} | {(f"s{rng.randint(0, 3)}", f"t{i}") for i in range(9)}
    once |= {(f"g{i}", f"s{rng.randint(0, 3)}") for i in range(6)}
    near = {}
    for a, b in once:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    pairs = [(f"g{i}", f"t{j}") for i in range(6) for j in range(9)]
    message = graph.undirected(spark.createDataFrame(sorted(once), "src string, dst string"))
    got = links.link_heuristics(spark.createDataFrame(pairs, "src string, dst string"), message)
    assert got.count() == len(pairs)
    for r in got.collect():
        a, b = near.get(r["src"], set()) - {r["dst"]}, near.get(r["dst"], set()) - {r["src"]}
        both = a & b
        assert r["common_neighbours"] == len(both)
        assert r["jaccard"] == pytest.approx(len(both) / len(a | b) if a | b else 0, abs=1e-6)
        assert r["adamic_adar"] == pytest.approx(sum(1 / math.log(len(near[v])) for v in both if len(near[v]) > 1), abs=1e-6)
        assert r["preferential_attachment"] == len(a) * len(b)


def test_ranking_marks_known(spark):
    nodes = typed(spark, 1, 2)
    z = spark.createDataFrame([("g0", [1.0, 0.0]), ("t0", [0.2, 0.0]), ("t1", [0.9, 0.0])], "id string, z array<double>")
    known = spark.createDataFrame([("g0", "t1")], "src string, dst string")
    ranked = links.rank_techniques(nodes, z, known, "g0")
    rows = ranked.orderBy("rank").collect()
    assert [(r["technique_id"], r["known"]) for r in rows] == [("t1", True), ("t0", False)]
    assert links.recovered_at_known(ranked).first().asDict() == {"n_known": 1, "recovered": 1}
    assert [r["id"] for r in links.new_predictions(ranked, 10).collect()] == ["t0"]
    assert links.find_group(graph.dense_index(nodes), "G0").count() == 1


def test_factors_find_planted_blocks(spark):
    pairs = [(f"g{g}", f"t{t}") for g in range(12) for t in range(24) if g % 3 == t % 3]
    nodes = typed(spark, 12, 24)
    edges = spark.createDataFrame(pairs, "src string, dst string")
    held = edges.filter(F.abs(F.hash("src", "dst")) % 6 == 0)
    z = links.link_factors(edges.exceptAll(held), nodes, rank=4).select("id", "z")
    negatives = graph.sample_negatives(nodes, edges, 60)
    result = links.evaluate_links(graph.pair_score(z, held), graph.pair_score(z, negatives)).first()
    assert result["roc_auc"] > 0.9


def test_bundle_schema_is_a_struct(spark):
    assert "kill_chain_phases" in spark.createDataFrame([], BUNDLE_OBJECT).columns


def test_trained_link_score_finds_planted_blocks(spark):
    """Groups and techniques of one block share software; held-out links lie inside blocks."""
    node = lambda kind, i: (f"{kind}{i}", kind, f"{kind} {i}", "")
    nodes = spark.createDataFrame(
        [node("group", i) for i in range(24)] + [node("technique", i) for i in range(40)] + [node("software", i) for i in range(12)],
        "id string, kind string, name string, ext_id string")
    pairs = [(g, t) for g in range(24) for t in range(40)]
    inside = [(g, t) for g, t in pairs if g % 4 == t % 4 and (3 * g + t) % 3 == 0]
    edge = lambda a, b: (a, b)
    around = [edge(f"group{g}", f"software{s}") for g in range(24) for s in range(12) if g % 4 == s % 4]
    around += [edge(f"software{s}", f"technique{t}") for t in range(40) for s in range(12) if t % 4 == s % 4 and (s + t) % 3]
    linked = [edge(f"group{g}", f"technique{t}") for g, t in inside]
    frame = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    message = graph.undirected(frame(around + linked[20:]))
    far = [edge(f"group{g}", f"technique{t}") for g, t in pairs if (g, t) not in inside and g % 4 != t % 4]
    model, labelled = links.train_link_score(frame(linked[:10]), frame(far[::9] + linked[:1]), message)
    assert labelled.filter("y = 1").count() == 10 and labelled.count() == 10 + len(far[::9])
    judged = links.score_links(frame(linked[10:20]).withColumn("y", F.lit(1)).unionByName(
        frame(far[1::9]).withColumn("y", F.lit(0))), message, model)
    auc = links.evaluate_links(judged.filter("y = 1"), judged.filter("y = 0")).first()["roc_auc"]
    assert auc > 0.95
    known = frame(linked)
    ranked = links.rank_by_link_score(nodes, message, known, "group0", model).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 41))
    assert all(a["score"] >= b["score"] for a, b in zip(ranked, ranked[1:]))
    assert {int(r["id"][9:]) % 4 for r in ranked[:10]} == {0}
    assert sum(r["known"] for r in ranked) == sum(e[0] == "group0" for e in linked)
    for missing in ("nobody", None):
        assert links.rank_by_link_score(nodes, message, known, missing, model).count() == 0


def test_heuristics_leave_own_edges_out_and_share_neighbours(spark):
    edges = [("g0", "t0"), ("g0", "t0"), ("g0", "s0"), ("s0", "t0"), ("g1", "t0"), ("g1", "s0"), (None, "t0")]
    message = graph.undirected(spark.createDataFrame(edges, "src string, dst string"))
    ready = links.neighbours(message)
    pairs = spark.createDataFrame([("g0", "t0"), ("g1", "t0"), ("g0", "g1"), ("g0", "nobody"), (None, "t0")], "src string, dst string")
    rows = lambda around: {(r["src"], r["dst"]): tuple(r)[2:] for r in links.link_heuristics(pairs, around).collect()}
    assert rows(ready) == rows(message)
    found = rows(ready)
    # g0 and t0 are linked: s0 is shared, and neither counts the other
    assert found["g0", "t0"][0] == 1 and found["g0", "t0"][3] == 1 * 3
    assert found["g0", "g1"][0] == 2 and found["g0", "g1"][3] == 2 * 2
    assert found["g0", "nobody"] == (0, 0.0, 0.0, 0) and found[None, "t0"][0] == 0
