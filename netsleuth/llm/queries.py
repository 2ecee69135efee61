"""The registered query of each operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from netsleuth.llm import (
    contamination, embedding_dedup, language_model, main_text, ngram_jaccard, packing, periodic_runs, quality, shared,
    substring_dedup, token_alignment, toxicity, url_filter, wavelet)
from netsleuth.plans.registry import Family
from netsleuth.sources.tables import table

FAMILY = Family()

#: Runs of bytes other than space and tab to carriage return, as SQL array code over ``text``.
_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER_WORDS = _WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _held_out(scored, threshold):
    return scored.select(
        "doc_id", (~toxicity.learnable(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


@FAMILY.register("op1_toxicity")
def op1_toxicity(spark, folder):
    return _held_out(toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")), 0.5)


@FAMILY.register("op2_quality")
def op2_quality(spark, folder):
    return _held_out(quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels")), 0.3)


OP3_SQL = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
starts as (select doc_id, p, w from docs, unnest(range(1, len(w) - 48)) as t(p) where len(w) >= 50),
windows as (select doc_id, p, array_to_string(w[p:p + 49], ' ') as s from starts),
firsts as (select s, min(doc_id) as first from windows group by s),
hit as (select doc_id, list(p) as ps from windows join firsts using (s) where doc_id > first group by doc_id),
covered as (select doc_id, list(distinct q) as qs from (select doc_id, unnest(ps) as p from hit), unnest(range(p, p + 50)) as t(q) group by doc_id),
rest as (select d.doc_id, w, coalesce(qs, []) as qs from docs d left join covered c using (doc_id))
select doc_id, len(w)::bigint as n_words, len(qs)::bigint as n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: not list_contains(qs, i)), ' ')) as kept_sha256
from rest
"""


@FAMILY.register("op3_substring_dedup", OP3_SQL)
def op3_substring_dedup(spark, folder):
    return substring_dedup.digest(table(spark, folder, "documents"))


OP4_SQL = """
with recursive raw as (select vec_id, embedding::double[] as v from embeddings where vec_id is not null),
good as (select vec_id, v from raw where v is not null and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0
           and len(list_filter(v, lambda x: x <> 0)) > 0),
pairs as (select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
          where list_cosine_similarity(a.v, b.v) >= 0.95),
reach as (select vec_id as a, vec_id as b from raw union select r.a, p.b from reach r join pairs p on r.b = p.a),
roots as (select a as vec_id, min(b) as component_id from reach group by a),
counts as (select a as vec_id, count(*) as n from pairs group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from raw join roots using (vec_id) left join counts using (vec_id)
"""


@FAMILY.register("op4_embedding_dedup", OP4_SQL)
def op4_embedding_dedup(spark, folder):
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


OP5_SQL = f"""
with recursive docs as (select doc_id, {_LOWER_WORDS} as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
           else list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) end as s from docs),
classes as (select min(doc_id) as id, s, len(s) as n from (select doc_id, list_sort(s) as s from sets where len(s) > 0) group by s),
pairs as (select a.id as a, b.id as b from classes a, classes b
          where a.id <> b.id and 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) and a.id < b.id
            and 100 * len(list_intersect(a.s, b.s)) >= 90 * (a.n + b.n - len(list_intersect(a.s, b.s)))),
links as (select a, b from pairs union all select b, a from pairs),
reach as (select id as a, id as b from classes union select r.a, l.b from reach r join links l on r.b = l.a),
roots as (select a as id, min(b) as component_id from reach group by a)
select s.doc_id, len(s.s)::bigint as n_shingles, coalesce(r.component_id, s.doc_id) as component_id
from sets s left join classes c on list_sort(s.s) = c.s left join roots r on c.id = r.id
"""


@FAMILY.register("op5_ngram_jaccard", OP5_SQL)
def op5_ngram_jaccard(spark, folder):
    return ngram_jaccard.jaccard_components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def _item_words(source, key):
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (f"select {key}, list_filter(string_split_regex({lowered}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w "
            f"from {source}")


OP6_SQL = f"""
with docs as ({_item_words('documents', 'doc_id')}), items as ({_item_words('benchmark', 'item_id')}),
win as (select distinct item_id, array_to_string(w[i:i + 9], ' ') as s, least(10, len(w)) as n
        from items, unnest(range(1, greatest(len(w) - 8, 2))) as t(i) where len(w) > 0),
sizes as (select distinct n from win),
spots as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as s
          from docs, sizes, unnest(range(1, len(w) - n + 2)) as t(i) where len(w) >= n),
hits as (select distinct doc_id, i, spots.n, s from spots where s in (select s from win)),
covered as (select doc_id, count(distinct q) as n_hit from hits, unnest(range(i, i + n)) as t(q) group by doc_id),
owners as (select doc_id, list_sort(list(distinct item_id::varchar)) as ids from hits join win using (s) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, len(coalesce(ids, []))::bigint as n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join covered using (doc_id) left join owners using (doc_id)
"""


@FAMILY.register("op6_contamination", OP6_SQL)
def op6_contamination(spark, folder):
    return contamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@FAMILY.register("op7_packing")
def op7_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


@FAMILY.register("op8_language_model")
def op8_language_model(spark, folder):
    return language_model.score_documents(table(spark, folder, "documents"))


@FAMILY.register("op9_wavelet")
def op9_wavelet(spark, folder):
    shards = shared.new_folder(spark, "tokens")
    wavelet.write_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), shards)
    return wavelet.read_tokens(spark, shards)


@FAMILY.register("op10_url_filter")
def op10_url_filter(spark, folder):
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@FAMILY.register("op11_main_text")
def op11_main_text(spark, folder):
    return main_text.extract(table(spark, folder, "pages"))


@FAMILY.register("op12_periodic_runs")
def op12_periodic_runs(spark, folder):
    planted = periodic_runs.plant_runs(table(spark, folder, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(planted))


@FAMILY.register("op13_token_alignment")
def op13_token_alignment(spark, folder):
    return token_alignment.alignment(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))
