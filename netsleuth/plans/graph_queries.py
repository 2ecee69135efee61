"""Registered queries of the graph family, each beside its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsleuth.functions.columns import hash_long, hash_uniform
from netsleuth.operators import graph, links, logistic
from netsleuth.operators.embeddings import centroids
from netsleuth.plans.flow_queries import _RANKS, md5_long
from netsleuth.plans.registry import Family
from netsleuth.session import durable
from netsleuth.sources import views
from netsleuth.sources.tables import table

FAMILY = Family()
register = FAMILY.register

N_HELD = "(select count(*) from split where part = 'test')"
DIMS = ["f0", "f1", "f2", "f3"]
GROUP_TEXT = "SUPPLIER#00000000"

NODES_SQL = (
    "nodes as (select 'intrusion-set--' || s_suppkey as id, 'group' as kind, s_name as name, '' as ext_id from supplier "
    "where s_acctbal >= 0 union all select 'attack-pattern--' || p_partkey, 'technique', p_name, "
    "'T' || lpad(p_partkey::varchar, 7, '0') from part union all "
    "select 'malware--' || c_custkey, 'software', c_name, '' from customer where c_acctbal >= 0)")
EDGES_SQL = (
    "sold as (select 'intrusion-set--' || l_suppkey as g, 'attack-pattern--' || l_partkey as t, 'malware--' || o_custkey as s "
    "from lineitem join orders on l_orderkey = o_orderkey), heads as (select p_brand, min(p_partkey) as head from part group by 1), "
    "every_edge as (select distinct g as src, t as dst, 'group_uses_technique' as rel from sold "
    "union all select distinct s, t, 'software_uses_technique' from sold "
    "union all select distinct g, s, 'group_uses_software' from sold "
    "union all select 'attack-pattern--' || p_partkey, 'attack-pattern--' || head, 'subtechnique_of' "
    "from part join heads using (p_brand) where p_partkey <> head), "
    "edges as (select * from every_edge where src in (select id from nodes) and dst in (select id from nodes))")
GRAPH_SQL = f"{NODES_SQL}, {EDGES_SQL}"
SPLIT_SQL = (
    "ranked_edges as (select src, dst, row_number() over (order by md5('42|' || src || '|' || dst), src, dst) as rk, "
    "count(*) over () as n from edges where rel = 'group_uses_technique'), "
    "split as (select src, dst, case when rk <= floor(n * 0.1::double) then 'test' "
    "when rk <= floor(n * 0.1::double) * 2 then 'val' else 'train' end as part from ranked_edges)")
MESSAGE_SQL = (
    "once as (select src, dst from edges where rel <> 'group_uses_technique' union all "
    "select src, dst from split where part = 'train'), "
    "message as (select src, dst from once union all select dst, src from once)")
INDEX_SQL = "row_number() over ({part} order by md5('0|' || id), id) - 1"


def _permuted_sql(seed=42):
    """Rounds of the keyed permutation: each takes (step, l, r) to the next."""
    out = ["f0 as (select step, step >> half as l, step & ((1::bigint << half) - 1) as r, half, cells, nt from steps)"]
    for turn in range(graph.ROUNDS):
        mixed = f"xor(l, ('0x' || substr(md5('{seed}.{turn}|' || r), 1, 8))::bigint & ((1::bigint << half) - 1))"
        out.append(f"f{turn + 1} as (select step, r as l, {mixed} as r, half, cells, nt from f{turn})")
    return ", ".join(out)


NEGATIVES_SQL = (
    "kinds as (select id, kind, " + INDEX_SQL.format(part="partition by kind") + " as idx from nodes), "
    "dims as (select count(*) filter (where kind = 'group') as ng, count(*) filter (where kind = 'technique') as nt from nodes), "
    "target as (select distinct src, dst from edges where rel = 'group_uses_technique'), "
    "sizes as (select ng * nt as cells, nt, greatest(1, ceil(ceil(log2(greatest(ng * nt, 1))) / 2))::bigint as half from dims), "
    "steps as (select unnest(range(1::bigint << (2 * half))) as step, half, cells, nt from sizes), "
    f"{_permuted_sql()}, "
    f"walk as (select step, (l << half) | r as code, nt from f{graph.ROUNDS} where ((l << half) | r) < cells), "
    "negatives as (select g.id as src, t.id as dst from walk join kinds g on g.kind = 'group' and g.idx = code // nt "
    "join kinds t on t.kind = 'technique' and t.idx = code % nt "
    "anti join target on g.id = target.src and t.id = target.dst "
    f"order by step limit {N_HELD})")


def _feature_sql(i):
    return f"('0x' || substr(md5('{i}|' || id), 1, 8))::bigint / 4294967296.0::double - 0.5::double"


def _hop_sql(prev, name):
    means = ", ".join(f"avg({c}) as m_{c}" for c in DIMS)
    blend = ", ".join(f"({c} + coalesce(m_{c}, {c})) / 2 as {c}" for c in DIMS)
    return (f"m_{name} as (select message.dst, {means} from message join {prev} on message.src = {prev}.id group by 1), "
            f"{name} as (select id, {blend} from {prev} left join m_{name} on id = dst)")


FEATURES_SQL = "x0 as (select id, " + ", ".join(f"{_feature_sql(i)} as {c}" for i, c in enumerate(DIMS)) + " from nodes)"
MEANS_SQL = f"{FEATURES_SQL}, {_hop_sql('x0', 'x1')}, {_hop_sql('x1', 'x2')}"


def nodes(spark, d):
    return graph.graph_nodes(views.knowledge_nodes(spark, d))


def edges(spark, d):
    return graph.graph_edges(views.knowledge_relations(spark, d), nodes(spark, d))


def message(spark, d, linked=None):
    linked = edges(spark, d) if linked is None else linked
    return graph.message_edges(linked, graph.target_split(linked))


def vectors(spark, d, linked=None):
    features = nodes(spark, d).select("id", *[
        (hash_uniform(i, F.col("id")) - 0.5).alias(c) for i, c in enumerate(DIMS)])
    linked = edges(spark, d) if linked is None else linked
    return graph.neighbour_mean(features, graph.message_once(linked, graph.target_split(linked)), DIMS, mirrored=True)


def negatives(spark, d, linked=None, split=None):
    """As many typed non-edges as there are test edges."""
    linked = edges(spark, d) if linked is None else linked
    split = graph.target_split(linked) if split is None else split
    held = split.filter("part = 'test'").count()
    return graph.sample_negatives(nodes(spark, d), linked.filter(F.col("rel") == graph.TARGET), held)


register("graph_nodes", f"with {NODES_SQL} select * from nodes")(nodes)
register("dense_index", f"with {NODES_SQL} select *, {INDEX_SQL.format(part='')} as idx from nodes")(
    lambda spark, d: graph.dense_index(nodes(spark, d)))
register("graph_edges", f"with {GRAPH_SQL} select * from edges")(edges)
register("graph_counts", f"with {GRAPH_SQL} select kind as what, count(*) as n from nodes group by 1 union all "
         "select rel, count(*) from edges group by 1")(
    lambda spark, d: graph.graph_counts(nodes(spark, d), edges(spark, d)))
register("undirected", f"with {GRAPH_SQL} select src, dst from edges union all select dst, src from edges")(
    lambda spark, d: graph.undirected(edges(spark, d)))
register("edge_split", f"with {GRAPH_SQL}, {SPLIT_SQL} select * from split")(
    lambda spark, d: graph.target_split(edges(spark, d)))
register("message_edges", f"with {GRAPH_SQL}, {SPLIT_SQL}, {MESSAGE_SQL} select * from message")(message)


@register("leaked_edges", f"with {GRAPH_SQL}, {SPLIT_SQL}, {MESSAGE_SQL} select count(*) as leaked from split "
          "semi join message using (src, dst) where part <> 'train'")
def _(spark, d):
    linked = edges(spark, d)
    split = graph.target_split(linked)
    return graph.leaked_edges(graph.message_edges(linked, split), split).agg(F.count(F.lit(1)).alias("leaked"))


register("sample_negatives", f"with {GRAPH_SQL}, {SPLIT_SQL}, {NEGATIVES_SQL} select * from negatives")(negatives)
register("neighbour_mean", f"with {GRAPH_SQL}, {SPLIT_SQL}, {MESSAGE_SQL}, {MEANS_SQL} select id, "
         + ", ".join(f"round({c}, 6) as {c}" for c in DIMS) + " from x2")(
    lambda spark, d: vectors(spark, d).select("id", *[F.round(c, 6).alias(c) for c in DIMS]))

CENTROIDS_SQL = (
    "dims as (select label, i, avg(embedding[i]::double) as v from embeddings, range(1, 65) as r(i) group by 1, 2), "
    "cent as (select label, list(round(v, 6) order by i) as c from dims group by 1)")


@register("pair_score", f"with {CENTROIDS_SQL} select vec_id as src, label as dst, round(1 / (1 + exp(-list_sum("
          "list_transform(range(1, 65), lambda i: embedding[i]::double * c[i])))), 6) as score "
          "from embeddings join cent using (label)")
def _(spark, d):
    vecs = table(spark, d, "embeddings")
    cents = centroids(vecs, "label", "embedding")
    z = vecs.select(F.concat(F.lit("v"), "vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("z"))
    z = z.unionByName(cents.select(F.concat(F.lit("c"), "label").alias("id"), F.col("centroid").alias("z")))
    pairs = vecs.select("vec_id", "label", F.concat(F.lit("v"), "vec_id").alias("src"), F.concat(F.lit("c"), "label").alias("dst"))
    return graph.pair_score(z, pairs).select(
        F.col("vec_id").alias("src"), F.col("label").alias("dst"), F.round("score", 6).alias("score"))


# factorisation is iterative: tested on planted blocks instead of SQL
@register("link_factors")
def _(spark, d):
    linked = edges(spark, d)
    train = graph.target_split(linked).filter("part = 'train'")
    return links.link_factors(train, nodes(spark, d)).select(
        "id", "kind", F.size("z").alias("rank"), F.round(F.sqrt(F.aggregate(
            F.transform("z", lambda v: (v * v).cast("double")), F.lit(0.0).cast("double"), lambda a, v: a + v)), 4).alias("norm"))


PAIRS_SQL = "pairs as (select src, dst, 1 as y from split where part = 'test' union all select src, dst, 0 from negatives)"
HEUR_SQL = (
    "msg as (select distinct src, dst from message), deg as (select src as node, count(*) as degree from msg group by 1), "
    "shared as (select p.src, p.dst, count(*) as cn, sum(case when v.degree > 1 then 1 / ln(v.degree) else 0 end) as aa "
    "from pairs p join msg a on a.src = p.src join msg b on b.src = p.dst and b.dst = a.dst "
    "join deg v on v.node = a.dst group by 1, 2), "
    "own as (select src, dst, 1 as own from pairs semi join msg using (src, dst)), "
    "base as (select p.src, p.dst, y, coalesce(s.degree, 0) - coalesce(own, 0) as ds, coalesce(t.degree, 0) - coalesce(own, 0) as dd, "
    "coalesce(cn, 0) as cn, coalesce(aa, 0) as aa from pairs p left join deg s on s.node = p.src left join deg t on t.node = p.dst "
    "left join shared h on h.src = p.src and h.dst = p.dst left join own o on o.src = p.src and o.dst = p.dst), "
    "heur as (select src, dst, y, cn::bigint as common_neighbours, "
    "round(case when ds + dd - cn > 0 then cn / (ds + dd - cn) else 0 end, 6) as jaccard, "
    "round(aa, 6)::double as adamic_adar, (ds * dd)::bigint as preferential_attachment from base)")
_ALL_SQL = f"{GRAPH_SQL}, {SPLIT_SQL}, {MESSAGE_SQL}, {NEGATIVES_SQL}, {PAIRS_SQL}, {HEUR_SQL}"


def held_out(spark, d):
    """Scored test edges and negatives, labelled."""
    linked = edges(spark, d)
    split = graph.target_split(linked)
    pairs = split.filter("part = 'test'").select("src", "dst", F.lit(1).alias("y")).unionByName(
        negatives(spark, d, linked, split).select("src", "dst", F.lit(0).alias("y")))
    scores = links.link_heuristics(pairs, graph.message_edges(linked, split))
    return scores.join(pairs, ["src", "dst"])


register("link_heuristics", f"with {_ALL_SQL} select * exclude (y) from heur")(
    lambda spark, d: held_out(spark, d).drop("y"))


@register("evaluate_links", f"with {_ALL_SQL}, scored as (select y, adamic_adar as score from heur), {_RANKS} "
          "select roc_auc, average_precision from auc")
def _(spark, d):
    scored = held_out(spark, d).select("y", F.col("adamic_adar").alias("score"))
    return links.evaluate_links(scored.filter("y = 1"), scored.filter("y = 0"))


_FIT_SQL = (
    f"{GRAPH_SQL}, {SPLIT_SQL}, {MESSAGE_SQL}, " + NEGATIVES_SQL.replace(N_HELD, "(select count(*) from split where part <> 'train')")
    + ", pairs as (select src, dst, 1 as y from split where part = 'val' union all select src, dst, 0 from negatives "
    f"where {md5_long(1, "src || '|' || dst")} % 2 = 0), {HEUR_SQL}")


def trained_links(spark, d):
    """A link score fitted on validation edges and half of the negatives, its pairs, and what is left to judge it by."""
    linked = edges(spark, d)
    split = graph.target_split(linked)
    around = links.neighbours(graph.message_edges(linked, split))
    part = lambda name: split.filter(F.col("part") == name).select("src", "dst")
    drawn = graph.sample_negatives(nodes(spark, d), linked.filter(F.col("rel") == graph.TARGET), split.filter("part <> 'train'").count())
    fitting = hash_long(1, F.concat_ws("|", "src", "dst")) % 2 == 0
    model, labelled = links.train_link_score(part("val"), drawn.filter(fitting), around)
    judged = part("test").withColumn("y", F.lit(1)).unionByName(drawn.filter(~fitting).withColumn("y", F.lit(0)))
    return model, labelled, judged, linked, around


@register("link_score_fit", f"with {_FIT_SQL} " + " union all ".join(
    f"select '{c}' as coefficient, count(*) as n, round(sum(y * {'1' if c == 'intercept' else f'ln(1 + {c}::double)'}), 4)::double as moment, "
    "true as settled from heur" for c in ["intercept", *links.SIGNALS]))
def _(spark, d):
    """The fit by coefficient; at its optimum the penalised gradient vanishes."""
    model, labelled, *_ = trained_links(spark, d)
    found = logistic.gradients(labelled, {"link": model})
    return found.select("coefficient", "n", F.round("moment", 4).alias("moment"), (F.abs("gradient") <= 1e-6).alias("settled"))


# the score comes from an iterative fit: tested on planted blocks instead of SQL
@register("evaluate_link_score")
def _(spark, d):
    model, _, judged, _, around = trained_links(spark, d)
    scored = durable(links.score_links(durable(judged), around, model))
    return links.evaluate_links(scored.filter("y = 1"), scored.filter("y = 0"))


@register("rank_by_link_score")
def _(spark, d):
    model, _, _, linked, around = trained_links(spark, d)
    group = links.find_group(graph.dense_index(nodes(spark, d)), GROUP_TEXT).first()
    return links.rank_by_link_score(
        nodes(spark, d), around, linked.filter(F.col("rel") == graph.TARGET), group and group["id"], model)


_FOUND = f"indexed as (select *, {INDEX_SQL.format(part='')} as idx from nodes), found as (select idx, id, name from indexed where kind = 'group' and contains(lower(name), '{GROUP_TEXT.lower()}'))"
register("find_group", f"with {NODES_SQL}, {_FOUND} select * from found")(
    lambda spark, d: links.find_group(graph.dense_index(nodes(spark, d)), GROUP_TEXT))

_RANKED_SQL = (
    f"{GRAPH_SQL}, {SPLIT_SQL}, {MESSAGE_SQL}, {MEANS_SQL}, {_FOUND}, "
    "chosen as (select id from found order by idx limit 1), gz as (select x2.* from x2 semi join chosen using (id)), "
    "sc as (select n.id, n.ext_id as technique_id, n.name, round(1 / (1 + exp(-("
    + " + ".join(f"z.{c} * gz.{c}" for c in DIMS) + "))), 4) as score, exists (select 1 from edges e where "
    "e.rel = 'group_uses_technique' and e.src = gz.id and e.dst = n.id) as known "
    "from nodes n join x2 z on n.id = z.id, gz where n.kind = 'technique'), "
    "ranked as (select *, row_number() over (order by score desc, md5('0|' || id), id) as rank from sc)")


def ranked_for_first(spark, d):
    """Techniques ranked for the first group whose name matches."""
    linked = edges(spark, d)
    known = linked.filter(F.col("rel") == graph.TARGET)
    z = vectors(spark, d, linked).select("id", F.array(*DIMS).alias("z"))
    group = links.find_group(graph.dense_index(nodes(spark, d)), GROUP_TEXT).first()
    # no group of that name has no ranking
    group = group and group["id"]
    return links.rank_techniques(nodes(spark, d), z, known, group)


register("rank_techniques", f"with {_RANKED_SQL} select * from ranked")(ranked_for_first)
register("recovered_at_known", f"with {_RANKED_SQL}, k as (select count(*) as n from ranked where known) "
         "select max(n) as n_known, count(*) filter (where known and rank <= n) as recovered from ranked, k")(
    lambda spark, d: links.recovered_at_known(ranked_for_first(spark, d)))
register("new_predictions", f"with {_RANKED_SQL} select * from ranked where not known order by rank limit 10")(
    lambda spark, d: links.new_predictions(ranked_for_first(spark, d)))
