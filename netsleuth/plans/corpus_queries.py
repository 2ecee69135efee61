"""Registered queries of the corpus and run families, each beside its SQL twin."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from netsleuth.functions.columns import cve_ids, technique_ids
from netsleuth.functions.schema import BUNDLE_OBJECT, CVE_SCHEMA
from netsleuth.operators import corpus, embeddings, retrieval, retrieval_eval, runs, signature_index, text_embedding
from netsleuth.plans.graph_queries import CENTROIDS_SQL
from netsleuth.plans.registry import Family
from netsleuth.session import durable
from netsleuth.sources.tables import table

FAMILY = Family()
register = FAMILY.register

# --- technique documents from JSON objects ---------------------------------


def bundle_objects(spark, d):
    """Technique objects as JSON text built from parts, parsed under the bundle schema."""
    text = lambda c: F.col(c).cast("string")
    ext = F.concat(F.lit("T"), F.lpad(text("p_partkey"), 7, "0"))
    refs = F.array(
        F.struct(F.lit("vendor").alias("source_name"), F.lit("V1").alias("external_id")),
        F.struct(F.when(F.col("p_size") < 48, "mitre-attack").otherwise("other").alias("source_name"),
                 ext.alias("external_id")))
    phases = F.when(F.col("p_size") > 10, F.array(
        F.struct(F.lit("mitre").alias("kill_chain_name"), F.lower("p_type").alias("phase_name")),
        F.struct(F.lit("mitre").alias("kill_chain_name"), F.lower("p_brand").alias("phase_name"))))
    described = F.concat(F.lit("Part "), F.col("p_name"), F.lit(" of type "), F.col("p_type"), F.lit("\nPrice "), text("p_size"))
    obj = F.struct(
        F.concat(F.lit("attack-pattern--"), text("p_partkey")).alias("id"), F.lit("attack-pattern").alias("type"),
        F.col("p_name").alias("name"), described.alias("description"), (F.col("p_size") == 47).alias("revoked"),
        (F.col("p_size") > 25).alias("x_mitre_is_subtechnique"),
        F.when(F.col("p_size") % 2 == 0, F.array("p_brand", "p_type")).alias("x_mitre_platforms"),
        phases.alias("kill_chain_phases"), refs.alias("external_references"))
    lines = table(spark, d, "part").select(F.to_json(obj).alias("line"))
    return lines.select(F.from_json("line", BUNDLE_OBJECT).alias("o")).select("o.*")


TECHNIQUES_SQL = (
    "tech as (select 'T' || lpad(p_partkey::varchar, 7, '0') as technique_id, p_name as name, "
    "case when p_size > 10 then lower(p_type) || ', ' || lower(p_brand) else '' end as tactics, "
    "case when p_size % 2 = 0 then p_brand || ', ' || p_type else '' end as platforms, p_size > 25 as is_subtechnique, "
    "'' as url, 'Part ' || p_name || ' of type ' || p_type || chr(10) || 'Price ' || p_size as description "
    "from part where p_size < 48 and p_size <> 47), "
    "docs as (select *, 'MITRE ATT&CK ' || case when is_subtechnique then 'Sub-technique ' else 'Technique ' end || technique_id "
    "|| ': ' || name || chr(10) || case when tactics <> '' then 'Tactics: ' || tactics || chr(10) else '' end || "
    "case when platforms <> '' then 'Platforms: ' || platforms || chr(10) else '' end || chr(10) || description as text from tech)")


@register("parse_objects", f"with {TECHNIQUES_SQL} select technique_id, name, tactics, platforms, is_subtechnique, url from docs")
def _(spark, d):
    return corpus.parse_techniques(bundle_objects(spark, d)).select(
        "technique_id", "name", F.array_join("tactics", ", ").alias("tactics"),
        F.array_join("platforms", ", ").alias("platforms"), "is_subtechnique", "url")


register("compose_text", f"with {TECHNIQUES_SQL} select technique_id, text from docs")(
    lambda spark, d: corpus.parse_techniques(bundle_objects(spark, d)).select("technique_id", "text"))
register("corpus_counts", f"with {TECHNIQUES_SQL} select count(*) as documents, count(*) filter (where not is_subtechnique) as "
         "techniques, count(*) filter (where is_subtechnique) as sub_techniques from docs")(
    lambda spark, d: corpus.corpus_counts(corpus.parse_techniques(bundle_objects(spark, d))))

# --- chunks ----------------------------------------------------------------
CHUNKS_SQL = (
    "cut as (select doc_id, source, text, unnest(range(greatest(1, ceil((length(text) - 120) / 780.0)::bigint))) as i "
    "from documents where length(text) > 0), chunks as (select doc_id, source, i::integer as chunk_no, "
    "doc_id || '#' || i as id, substr(text, i * 780 + 1, 900) as chunk_text from cut)")


def chunks(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return corpus.chunk_fixed(docs).withColumn("id", F.concat(F.col("doc_id").cast("string"), F.lit("#"), F.col("chunk_no").cast("string")))


def passages(spark, d):
    return chunks(spark, d).select("id", F.col("doc_id").alias("source_id"), F.col("source").alias("name"),
                                   F.col("chunk_text").alias("passage"))


register("chunk_fixed", f"with {CHUNKS_SQL} select doc_id, source, chunk_no, chunk_text from chunks")(
    lambda spark, d: corpus.chunk_fixed(table(spark, d, "documents").select("doc_id", "source", "text")))
register("chunk_coverage", "select doc_id, length(text)::integer as covered, true as longest_fits, true as in_order from documents "
         "where length(text) > 0")(lambda spark, d: corpus.chunk_coverage(table(spark, d, "documents"), "doc_id"))
# the texts themselves are held against a plain recursive cutter in the tests
register("chunk_recursive")(
    lambda spark, d: corpus.chunk_recursive(table(spark, d, "documents").select("doc_id", "source", "text")))

# --- weights and retrieval -------------------------------------------------


def postings_sql(source, key, text, name):
    return (f"{name}_w as (select {key} as id, regexp_extract_all(lower({text}), '(\\p{{L}}+)', 1) as w from {source}), "
            f"{name} as (select id, len(w) as length, unnest(w) as term from {name}_w), "
            f"{name}_p as (select id, length, term, count(*) as tf from {name} group by all), "
            f"{name}_df as (select term, count(*) as df from {name}_p group by 1), "
            f"{name}_n as (select count(*) as n, avg(length) as avgdl from (select distinct id, length from {name}_p))")


def weights_sql(name):
    return (f"{name}_r as (select id, term, tf * ln((n + 1) / (df + 1)) + tf as w from {name}_p join {name}_df using (term), {name}_n), "
            f"{name}_wt as (select id, term, w / sqrt(sum(w * w) over (partition by id)) as weight from {name}_r)")


def query_sql(name, questions="benchmark", key="item_id", text="text"):
    return (f"qt as (select {key} as q_id, unnest(regexp_extract_all(lower({text}), '(\\p{{L}}+)', 1)) as term from {questions}), "
            "qc as (select q_id, term, count(*) as tf from qt group by all), "
            f"qr as (select q_id, term, tf * ln((n + 1) / (coalesce(df, 0) + 1)) + tf as w from qc left join {name}_df using (term), {name}_n), "
            "qw as (select q_id, term, w / sqrt(sum(w * w) over (partition by q_id)) as wq from qr)")


def stage1_sql(name, k=12):
    return (f"s1 as (select q_id, id, round(sum(weight * wq), 6) as score from {name}_wt join qw using (term) group by 1, 2), "
            f"cand as (select *, row_number() over (partition by q_id order by score desc, id)::integer as stage1_rank from s1 "
            f"qualify stage1_rank <= {k})")


def rerank_sql(name, n=4):
    return (f"bm as (select c.q_id, c.id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2::double / "
            "(tf + 1.2::double * (0.25::double + 0.75::double * length / avgdl))) as s from cand c join "
            f"(select distinct q_id, term from qc) q using (q_id) join {name}_df using (term) "
            f"join {name}_p p on p.id = c.id and p.term = q.term, {name}_n group by 1, 2), "
            "rr as (select cand.*, round(coalesce(s, 0), 4) as rerank_score from cand left join bm using (q_id, id)), "
            f"hits as (select *, row_number() over (partition by q_id order by rerank_score desc, stage1_rank)::integer as rank from rr "
            f"qualify rank <= {n})")


INDEX_SQL = f"{CHUNKS_SQL}, {postings_sql('chunks', 'id', 'chunk_text', 'p')}, {weights_sql('p')}"
RETRIEVE_SQL = f"{INDEX_SQL}, {query_sql('p')}, {stage1_sql('p')}, {rerank_sql('p')}"
PASSAGE_SQL = f"{RETRIEVE_SQL}, found as (select hits.*, doc_id as source_id, source as name, chunk_text as passage from hits join chunks using (id))"


def chunk_postings(spark, d):
    return retrieval.build_postings(chunks(spark, d), "id", "chunk_text")


def questions(spark, d):
    return table(spark, d, "benchmark")


def hits(spark, d):
    return retrieval.retrieve(questions(spark, d), "item_id", "text", chunk_postings(spark, d))


def found(spark, d):
    return retrieval.with_passages(hits(spark, d), passages(spark, d))


register("tfidf_weights", f"with {postings_sql('documents', 'doc_id', 'text', 'p')}, {weights_sql('p')} "
         "select id, term, round(weight, 6) as weight from p_wt")(
    lambda spark, d: retrieval.tfidf_weights(
        retrieval.build_postings(table(spark, d, "documents"), "doc_id", "text")).select(
        "id", "term", F.round("weight", 6).alias("weight")))


@register("sparse_topk", f"with {INDEX_SQL}, {query_sql('p')}, {stage1_sql('p')} select * from cand")
def _(spark, d):
    postings = chunk_postings(spark, d)
    asked = retrieval.query_weights(questions(spark, d), "item_id", "text", postings)
    return retrieval.sparse_topk(asked, retrieval.banded_weights(postings))


def bounded_search(spark, d):
    """Hits and fully scored pairs of the search by bounds, with the questions and weights it ran on."""
    postings = chunk_postings(spark, d)
    asked = durable(retrieval.query_weights(questions(spark, d), "item_id", "text", postings))
    weights = retrieval.banded_weights(postings)
    return *retrieval.sparse_search(asked, weights), asked, weights


register("sparse_bounded", f"with {INDEX_SQL}, {query_sql('p')}, {stage1_sql('p')} select * from cand")(
    lambda spark, d: bounded_search(spark, d)[0])


@register("sparse_pruning", f"with {INDEX_SQL}, {query_sql('p')}, {stage1_sql('p')} select count(*) as pairs, true as scored_under_a_tenth from s1")
def _(spark, d):
    _, reached, asked, weights = bounded_search(spark, d)
    scored = reached.agg(F.count(F.lit(1))).scalar()
    return retrieval.sharing_pairs(asked, weights).select("pairs", (scored < 0.1 * F.col("pairs")).alias("scored_under_a_tenth"))


register("rerank_bm25", f"with {RETRIEVE_SQL} select q_id, id, stage1_rank, rerank_score, rank from hits")(
    lambda spark, d: hits(spark, d).select("q_id", "id", "stage1_rank", "rerank_score", "rank"))
register("two_stage_retrieve", f"with {PASSAGE_SQL} select q_id, rank, source_id, name, passage from found")(
    lambda spark, d: found(spark, d).select("q_id", "rank", "source_id", "name", "passage"))
register("format_context", f"with {PASSAGE_SQL} select q_id, string_agg('[' || rank || '] (' || source_id || ' — ' || name || ')' "
         "|| chr(10) || passage, chr(10) || chr(10) order by rank) as context from found group by 1")(
    lambda spark, d: retrieval.format_context(found(spark, d)))


@register("retrieval_samples", f"with {PASSAGE_SQL} select q_id, string_agg(passage, '|' order by rank) as contexts, "
          "string_agg(source_id::varchar, ',' order by rank) as source_ids from found group by 1")
def _(spark, d):
    return retrieval.retrieval_samples(found(spark, d)).select(
        "q_id", F.array_join("contexts", "|").alias("contexts"),
        F.array_join(F.transform("source_ids", lambda s: s.cast("string")), ",").alias("source_ids"))


# --- dense vectors ---------------------------------------------------------
VECTOR_SQL = (
    f"{CENTROIDS_SQL}, cn as (select label as q_id, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)))) "
    "as q from cent), sims as (select q_id, vec_id as id, round(list_sum(list_transform(range(1, 65), "
    "lambda i: embedding[i]::double * q[i])), 6) as score from embeddings, cn), "
    "near as (select *, (row_number() over (partition by q_id order by score desc, id))::integer as rank from sims qualify rank <= 12)")


def asked_and_held(spark, d):
    """The centroid of each label as a query, and all vectors."""
    vecs = table(spark, d, "embeddings")
    asked = embeddings.centroids(vecs, "label", "embedding").select(F.col("label").alias("q_id"), F.col("centroid").alias("vector"))
    return asked, vecs.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def nearest(spark, d):
    return embeddings.vector_topk(*asked_and_held(spark, d))


def indexed(spark, d):
    """Recall and scored pairs of the signature index against the exact search."""
    asked, held = asked_and_held(spark, d)
    asked = durable(asked)
    hits, found = signature_index.index_topk(asked, held)
    return signature_index.search_report(hits, embeddings.vector_topk(asked, held), found, asked, held)


def label_items(spark, d):
    return table(spark, d, "embeddings").select(F.col("label").alias("q_id"), F.col("vec_id").alias("item"))


register("vector_topk", f"with {VECTOR_SQL} select q_id, id, score, rank from near")(nearest)
# an approximate search: how much it finds and scores, and whether that is enough
register("vector_topk_probe")(lambda spark, d: indexed(spark, d).select("hits", "recall"))


@register("vector_index", f"with {VECTOR_SQL} select count(*) as hits, true as finds_nine_tenths, true as scores_under_a_fifth from near")
def _(spark, d):
    return indexed(spark, d).select("hits", (F.col("recall") >= 0.9).alias("finds_nine_tenths"),
                                    (F.col("scored_share") < 0.2).alias("scores_under_a_fifth"))


_PRECISION = ("(select {h}.q_id, rank, (r.q_id is not null)::integer as rel, sum((r.q_id is not null)::integer) over "
              "(partition by {h}.q_id order by rank) as upto from {h} left join {r} r on r.q_id = {h}.q_id and r.item = {h}.item)")


def precision_sql(h, r):
    return (f"select q_id, round(case when sum(rel) > 0 then sum(upto / rank * rel) / sum(rel) else 0 end, 4) as context_precision "
            f"from {_PRECISION.format(h=h, r=r)} group by 1")


def recall_sql(h, r):
    return (f"select r.q_id, round(count(s.item) / count(*), 4) as context_recall from {r} r left join (select distinct q_id, item "
            f"from {h}) s on s.q_id = r.q_id and s.item = r.item group by 1")


_VEC_JUDGED = f"with {VECTOR_SQL}, h as (select q_id, id as item, rank from near), rel as (select label as q_id, vec_id as item from embeddings) "
register("vector_precision", _VEC_JUDGED + precision_sql("h", "rel"))(
    lambda spark, d: retrieval_eval.context_precision(
        nearest(spark, d).withColumnRenamed("id", "item"), label_items(spark, d)))
register("vector_recall", _VEC_JUDGED + recall_sql("h", "rel"))(
    lambda spark, d: retrieval_eval.context_recall(
        nearest(spark, d).withColumnRenamed("id", "item"), label_items(spark, d)))

RELEVANT_SQL = "rel as (select item_id as q_id, doc_id as item from benchmark b join documents d on contains(d.text, b.text))"


def relevant(spark, d):
    """Documents that hold a benchmark passage verbatim."""
    return retrieval_eval.passages_containing(
        questions(spark, d).select(F.col("item_id").alias("q_id"), F.col("text").alias("passage")),
        table(spark, d, "documents").select("doc_id", "text")).withColumnRenamed("doc_id", "item")


def document_hits(spark, d):
    """Hits as documents, each at its best rank."""
    return hits(spark, d).select("q_id", F.substring_index("id", "#", 1).cast("bigint").alias("item"), "rank").groupBy(
        "q_id", "item").agg(F.min("rank").alias("rank"))


_TEXT_JUDGED = f"with {RETRIEVE_SQL}, {RELEVANT_SQL}, h as (select q_id, split_part(id, '#', 1)::bigint as item, min(rank) as rank from hits group by 1, 2) "
register("relevant_documents", f"with {RELEVANT_SQL} select * from rel")(relevant)
register("context_precision", _TEXT_JUDGED + precision_sql("h", "rel"))(
    lambda spark, d: retrieval_eval.context_precision(document_hits(spark, d), relevant(spark, d)))
register("context_recall", _TEXT_JUDGED + recall_sql("h", "rel"))(
    lambda spark, d: retrieval_eval.context_recall(document_hits(spark, d), relevant(spark, d)))

# --- dense vectors of texts ------------------------------------------------


def embedded(spark, d):
    """The documents' postings and their dense vectors."""
    postings = retrieval.build_postings(table(spark, d, "documents"), "doc_id", "text")
    return postings, text_embedding.embed_text(retrieval.tfidf_weights(postings))


@register("text_embeddings", f"with {postings_sql('documents', 'doc_id', 'text', 'p')}, {weights_sql('p')}, "
          "mass as (select term, sum(weight * weight) as m from p_wt group by 1), "
          "top as (select sum(m) as m from (select m from mass order by m desc limit 32)) "
          "select (select count(distinct id) from p_wt) as texts, round((select m from top) / (select sum(m) from mass), 4) "
          "as best_terms_share, true as unit_length, true as orthonormal, true as keeps_more_than_best_terms")
def _(spark, d):
    made = embedded(spark, d)[1]
    mass = made.weights.groupBy("term").agg(F.sum(F.col("weight") * F.col("weight")).alias("m"))
    top = mass.orderBy(F.desc("m")).limit(made.dim).agg(F.sum("m")).scalar() / mass.agg(F.sum("m")).scalar()
    names = [c for c in made.basis.columns if c != "id"]
    off = float(abs(text_embedding.gram(made.basis, names) - np.eye(len(names))).max())
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return made.texts.agg(F.count(F.lit(1)).alias("texts"), F.max(F.abs(length - 1.0)).alias("_off")).select(
        "texts", F.round(top, 4).alias("best_terms_share"), (F.col("_off") < 1e-9).alias("unit_length"),
        F.lit(off < 1e-8).alias("orthonormal"), (F.lit(made.captured) > top).alias("keeps_more_than_best_terms"))


def dense_hits(spark, d):
    """Dense first stage, word-based second: the 12 nearest documents of each question, reranked to 4."""
    postings, made = embedded(spark, d)
    asked = text_embedding.embed_queries(retrieval.query_weights(questions(spark, d), "item_id", "text", postings), made)
    near = durable(embeddings.vector_topk(asked, made.texts).withColumnRenamed("rank", "stage1_rank"))
    return near, retrieval.rerank(retrieval.bm25_scores(near, questions(spark, d), "item_id", "text", postings))


@register("dense_retrieve", f"with {postings_sql('documents', 'doc_id', 'text', 'p')}, {query_sql('p')} select count(distinct q_id) as questions, "
          "4 * count(distinct q_id) as hits, true as finds_more_than_chance from qw join p_df using (term)")
def _(spark, d):
    near, best = dense_hits(spark, d)
    found = retrieval_eval.context_recall(near.withColumnRenamed("id", "item"), relevant(spark, d))
    chance = F.lit(retrieval.TOP_K) / table(spark, d, "documents").agg(F.count(F.lit(1))).scalar()
    return best.agg(F.count_distinct("q_id").alias("questions"), F.count(F.lit(1)).alias("hits")).select(
        "questions", "hits", (found.agg(F.avg("context_recall")).scalar() > 2 * chance).alias("finds_more_than_chance"))


# --- answers ---------------------------------------------------------------


@register("groundedness", "with words as (select conv_id, turn, unnest(list_distinct(regexp_extract_all(lower(text), '(\\p{L}+)', 1))) "
          "as word from conversations), firsts as (select conv_id, word, min(turn) as ft from words group by 1, 2), "
          "sents as (select conv_id, turn, unnest(regexp_split_to_array(text, '[.!?]\\s+')) as sentence, "
          "generate_subscripts(regexp_split_to_array(text, '[.!?]\\s+'), 1) as no from conversations where role = 'assistant'), "
          "sw as (select conv_id, turn, no, unnest(list_distinct(regexp_extract_all(lower(sentence), '(\\p{L}+)', 1))) as word from sents), "
          "sup as (select conv_id, turn, no, count(*) filter (where ft < turn) / count(*) >= 0.5 as ok from sw left join firsts "
          "using (conv_id, word) group by 1, 2, 3), g as (select conv_id, turn, round(count(*) filter (where ok) / count(*), 4) "
          "as groundedness from sup group by 1, 2) select conv_id as run, turn, groundedness from conversations left join g "
          "using (conv_id, turn) where role = 'assistant'")
def _(spark, d):
    talk = table(spark, d, "conversations").withColumnRenamed("conv_id", "run")
    return retrieval_eval.groundedness(
        talk.filter("role = 'assistant'").select("run", "turn", F.col("text").alias("answer")),
        talk.select("run", "turn", "text"))


@register("answer_relevancy", "with turns as (select conv_id || '#' || turn as id, text from conversations), "
          f"{postings_sql('turns', 'id', 'text', 'p')}, {weights_sql('p')}, pairs as (select u.conv_id || '#' || u.turn as q_id, "
          "a.conv_id || '#' || a.turn as a_id from conversations u join conversations a on a.conv_id = u.conv_id "
          "and a.turn = u.turn + 1 where u.role = 'user' and a.role = 'assistant'), "
          "c as (select q_id, a_id, sum(x.weight * y.weight) as c from pairs join p_wt x on x.id = q_id "
          "join p_wt y on y.id = a_id and y.term = x.term group by 1, 2) "
          "select q_id, a_id, round(coalesce(c, 0), 4) as relevancy from pairs left join c using (q_id, a_id)")
def _(spark, d):
    talk = table(spark, d, "conversations")
    key = F.concat(F.col("conv_id").cast("string"), F.lit("#"), F.col("turn").cast("string"))
    turns = talk.select("conv_id", "turn", "role", key.alias("id"))
    asked = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("id").alias("q_id"))
    said = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("id").alias("a_id"))
    weights = retrieval.tfidf_weights(retrieval.build_postings(talk.select(key.alias("id"), "text"), "id", "text"))
    return retrieval_eval.answer_relevancy(asked.join(said, ["conv_id", "turn"]).select("q_id", "a_id"), weights)


_ID_PATTERNS = [r"\b(T\d{4}(?:\.\d{3})?)\b", r"\b(CVE-\d{4}-\d{4,})\b", r"(\d{2,})"]


# the test pages cite neither techniques nor CVEs, so numbers are taken as a third kind of id
@register("extract_ids", "with t as (select page_id, concat_ws(' ', url, html) as body from pages), found as ("
          + " union all ".join(f"select page_id, unnest(regexp_extract_all(body, '{p}', 1)) as mention from t" for p in _ID_PATTERNS)
          + ") select distinct page_id, mention, split_part(mention, '.', 1) as parent from found")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("body"))
    numbers = F.regexp_extract_all("body", F.lit(_ID_PATTERNS[2]), 1)
    return corpus.extract_ids(pages, "page_id", F.concat(technique_ids(F.col("body")), cve_ids(F.col("body")), numbers))


@register("technique_mentions", f"with {TECHNIQUES_SQL} select distinct technique_id, mention, split_part(mention, '.', 1) as parent "
          "from (select technique_id, unnest(regexp_extract_all('T' || substr(technique_id, 5) || '.' || substr(technique_id, 2, 3) "
          "|| ' ' || text, '\\b(T\\d{4}(?:\\.\\d{3})?)\\b', 1)) as mention from docs)")
def _(spark, d):
    docs = corpus.parse_techniques(bundle_objects(spark, d))
    cited = F.concat(F.lit("T"), F.substring("technique_id", 5, 4), F.lit("."), F.substring("technique_id", 2, 3),
                     F.lit(" "), F.col("text"))
    return corpus.extract_ids(docs, "technique_id", technique_ids(cited))


register("eval_set_check", "with r as (select 'expect_column_values_to_not_be_null:user_input' as rule, count(*) as evaluated, "
         "count(*) filter (where text is null) as violations from benchmark union all "
         "select 'expect_column_values_to_match_regex:user_input', count(*), count(*) filter (where not regexp_matches(text, '\\S')) "
         "from benchmark union all select 'expect_column_values_to_not_be_null:reference', count(*), "
         "count(*) filter (where text is null) from benchmark union all "
         "select 'expect_column_values_to_match_regex:reference', count(*), count(*) filter (where not regexp_matches(text, "
         "'[Tt]h[aeiou]n')) from benchmark) select *, violations = 0 as success from r")(
    lambda spark, d: corpus.eval_set_check(
        questions(spark, d).select(F.col("text").alias("user_input"), F.col("text").alias("reference")), "[Tt]h[aeiou]n"))

# --- investigation runs ----------------------------------------------------


@register("attack_search", f"with {PASSAGE_SQL}, a as (select q_id, string_agg(source_id || ' — ' || name || ': ' || "
          "substr(passage, 1, 280), chr(10) || chr(10) order by rank) as reply from found group by 1) "
          "select item_id as q_id, coalesce(reply, 'No matching ATT&CK techniques found.') as reply from benchmark left join a on q_id = item_id")
def _(spark, d):
    return runs.attack_search(questions(spark, d).select(F.col("item_id").alias("q_id")), found(spark, d))


@register("map_indicator", f"with {PASSAGE_SQL} select item_id as q_id, coalesce(source_id || ' — ' || name, 'No technique match.') "
          "as technique from benchmark left join (select * from found where rank = 1) on q_id = item_id")
def _(spark, d):
    return runs.map_indicator(questions(spark, d).select(F.col("item_id").alias("q_id")), found(spark, d))


def cve_records(spark, d):
    """Nested CVE records as JSON text built from events, parsed under the record schema."""
    kind = F.col("event_type")
    words = F.concat(F.lit("Event "), kind, F.lit(" by "), F.col("user_id").cast("string"))
    described = F.when(kind == "view", F.array(F.struct(F.lit("fr").alias("lang"), words.alias("value")))).otherwise(F.array(
        F.struct(F.lit("fr").alias("lang"), F.lit("autre").alias("value")),
        F.struct(F.lit("en").alias("lang"), words.alias("value"))))
    score = F.round(F.col("user_id") % 100 / 10.0, 1)
    rated = lambda severity: F.array(F.struct(F.struct(
        score.alias("baseScore"), severity.alias("baseSeverity")).alias("cvssData")))
    only = lambda when, value: F.when(kind.isin(*when), value)
    metrics = F.struct(
        only(["error"], rated(F.lit("HIGH"))).alias("cvssMetricV31"),
        only(["error", "click"], rated(F.lit("LOW"))).alias("cvssMetricV30"),
        only(["view", "click"], rated(F.lit(None).cast("string"))).alias("cvssMetricV2"))
    obj = F.struct(F.concat(F.lit("CVE-2024-"), F.col("event_id").cast("string")).alias("id"),
                   described.alias("descriptions"), metrics.alias("metrics"))
    lines = table(spark, d, "events").select(F.to_json(obj).alias("line"))
    return lines.select(F.from_json("line", CVE_SCHEMA).alias("c")).select("c.*")


@register("cve_lookup", "with c as (select 'CVE-2024-' || event_id as id, case when event_type = 'view' then '(no description)' else "
          "'Event ' || event_type || ' by ' || user_id end as description, round(user_id % 100 / 10.0::double, 1) as s, "
          "event_type as k from events), asked as (select ' CVE-2024-' || (event_id * 2) || ' ' as cve_id from events) "
          "select cve_id, case when id is null then 'No NVD record found for ' || cve_id || '.' else cve_id || ': CVSS ' || "
          "case k when 'error' then s || ' (HIGH)' when 'click' then s || ' (LOW)' when 'view' then s || ' (n/a)' "
          "else 'unknown' end || '. ' || description end as reply from asked left join c on trim(cve_id) = id")
def _(spark, d):
    asked = table(spark, d, "events").select(F.concat(
        F.lit(" CVE-2024-"), (F.col("event_id") * 2).cast("string"), F.lit(" ")).alias("cve_id"))
    return runs.cve_lookup(asked, cve_records(spark, d))


TASKS_SQL = ("asks as (select conv_id as run, min_by(text, turn) filter (where role = 'user') as ask from conversations group by 1), "
             "tasks as (select run, 'assistant' as expected_tool, split_part(coalesce(ask, ''), ' ', 1) as word from asks)")
SCORES_SQL = (
    f"{TASKS_SQL}, per_tool as (select conv_id as run, role as tool, count(*) as n from conversations group by 1, 2), "
    "shape as (select run, sum(n) as calls, max(n) as most, bool_or(tool = 'assistant') as sel from per_tool group by 1), "
    "last as (select conv_id as run, max_by(text, turn) as answer from conversations group by 1), "
    "scores as (select run, expected_tool, coalesce(sel, false) as tool_selection_ok, contains(lower(answer), lower(word)) as "
    "task_completed, calls between 1 and 6 and most <= 2 as trajectory_valid from tasks left join shape using (run) left join last using (run))")


def messages(spark, d):
    return table(spark, d, "conversations").select(F.col("conv_id").alias("run"), "turn", F.col("role").alias("tool"), "text")


def scores(spark, d):
    talk = messages(spark, d)
    asks = talk.groupBy("run").agg(F.min_by("text", F.when(F.col("tool") == "user", F.col("turn"))).alias("ask"))
    tasks = asks.select("run", F.lit("assistant").alias("expected_tool"),
                        F.array(F.split_part(F.coalesce("ask", F.lit("")), F.lit(" "), F.lit(1))).alias("expected_contains"))
    return runs.score_runs(tasks, runs.trajectories(talk), runs.run_outcomes(talk))


register("trajectories", "select conv_id as run, row_number() over (partition by conv_id order by turn) as step, role as tool "
         "from conversations")(lambda spark, d: runs.trajectories(messages(spark, d)))
register("run_outcomes", "select conv_id as run, max_by(text, turn) as answer, count(*) as n_steps from conversations group by 1")(
    lambda spark, d: runs.run_outcomes(messages(spark, d)))
register("score_runs", f"with {SCORES_SQL} select * from scores")(scores)
register("run_summary", f"with {SCORES_SQL} select count(*) as n_tasks, round(avg(tool_selection_ok::integer), 3) as "
         "tool_selection_accuracy, round(avg(trajectory_valid::integer), 3) as trajectory_validity_rate, "
         "round(avg(task_completed::integer), 3) as task_completion_rate from scores")(
    lambda spark, d: runs.run_summary(scores(spark, d)))

# first user message of each conversation as the description of one CVE
_CVE_Q = "cveq as (select 'CVE-2025-' || conv_id as item_id, min_by(text, turn) filter (where role = 'user') as text from conversations group by conv_id)"


@register("cve_technique_links", f"with {_CVE_Q}, {INDEX_SQL}, {query_sql('p', 'cveq')}, {stage1_sql('p')}, {rerank_sql('p')} "
          "select item_id as cve_id, coalesce(doc_id || ' — ' || source, 'No technique match.') as technique from cveq "
          "left join (select q_id, doc_id, source from hits join chunks using (id) where rank = 1) on q_id = item_id")
def _(spark, d):
    first = table(spark, d, "conversations").groupBy("conv_id").agg(
        F.min_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("text"))
    cves = first.select(
        F.concat(F.lit("CVE-2025-"), F.col("conv_id").cast("string")).alias("id"),
        F.array(F.struct(F.lit("en").alias("lang"), F.col("text").alias("value"))).alias("descriptions"),
        F.from_json(F.lit("{}"), CVE_SCHEMA)["metrics"].alias("metrics"))
    asked = runs.flatten_cves(cves)
    best = retrieval.retrieve(asked, "id", "description", chunk_postings(spark, d))
    return runs.cve_technique_links(cves, retrieval.with_passages(best, passages(spark, d)))
