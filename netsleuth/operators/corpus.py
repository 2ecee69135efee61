"""Knowledge corpus: bundle objects to technique documents to chunks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.operators import gate
from netsleuth.operators.graph import active, mitre_reference

CHUNK_SIZE = 900
CHUNK_OVERLAP = 120
# Separators tried in this order when a piece is too long.
SEPARATORS = ["\n\n", "\n", ". ", " ", ""]
# The white space that a chunk loses at its ends.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def compose_text(technique_id: Column, name: Column, tactics: Column, platforms: Column,
                 is_sub: Column, description: Column) -> Column:
    """Searchable text: header, optional tactic and platform lines, blank line, description."""
    header = F.concat(F.lit("MITRE ATT&CK "), F.when(is_sub, "Sub-technique").otherwise("Technique"),
                      F.lit(" "), technique_id, F.lit(": "), name)
    line = lambda label, values: F.when(
        F.size(values) > 0, F.concat(F.lit(label + ": "), F.array_join(values, ", "), F.lit("\n"))).otherwise("")
    return F.concat(header, F.lit("\n"), line("Tactics", tactics), line("Platforms", platforms), F.lit("\n"), description)


def parse_techniques(objects: DataFrame) -> DataFrame:
    """Active techniques with an id as retrieval documents."""
    none = F.array().cast("array<string>")
    ref = mitre_reference()
    tactics = F.coalesce(F.transform("kill_chain_phases", lambda p: p["phase_name"]), none)
    platforms = F.coalesce("x_mitre_platforms", none)
    is_sub = F.coalesce("x_mitre_is_subtechnique", F.lit(False))
    found = objects.filter((F.col("type") == "attack-pattern") & active()).select(
        ref["external_id"].alias("technique_id"), "name", tactics.alias("tactics"), platforms.alias("platforms"),
        is_sub.alias("is_subtechnique"), F.coalesce(ref["url"], F.lit("")).alias("url"), "description")
    c = F.col
    return found.filter(F.length("technique_id") > 0).select(
        c("technique_id").alias("id"), "technique_id", "name", "tactics", "platforms", "is_subtechnique", "url",
        compose_text(c("technique_id"), c("name"), c("tactics"), c("platforms"), c("is_subtechnique"),
                     c("description")).alias("text"))


def corpus_counts(documents: DataFrame) -> DataFrame:
    sub = F.count_if(F.col("is_subtechnique"))
    n = F.count(F.lit(1))
    return documents.agg(n.alias("documents"), (n - sub).alias("techniques"), sub.alias("sub_techniques"))


def chunk_fixed(df: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Sliding character windows with the row's other columns carried along.

    The text is cut once into pieces of ``size - overlap`` characters; a window is a
    piece and the start of the next, so the work is linear in the text. A last piece
    no longer than the overlap is covered by its predecessor and makes no window.
    """
    step = size - overlap
    if not 0 <= overlap < step:
        raise ValueError("overlap must be less than half the size")
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{step}}})"), 1)
    carried = [c for c in df.columns if c != text]
    cut = df.select(*carried, pieces.alias("_p"))
    window = lambda piece, i: F.concat(piece, F.coalesce(F.substring(F.get("_p", i + 1), 1, overlap), F.lit("")))
    numbered = F.transform("_p", lambda piece, i: F.struct(window(piece, i).alias("w"), F.length(piece).alias("n")))
    return cut.select(*carried, F.posexplode(numbered).alias("chunk_no", "_w")).filter(
        (F.col("chunk_no") == 0) | (F.col("_w.n") > overlap)).select(*carried, "chunk_no", F.col("_w.w").alias("chunk_text"))


def _pieces(text: Column, size: int, separators: list[str]) -> Column:
    """Texts cut level by level at the separators, each kept with the text after it, until
    no piece is longer than ``size``; characters are the last resort."""
    def cut(piece, separator):
        if separator == "":
            return F.split(piece, "")
        parts = F.transform(F.split(piece, re.escape(separator)),
                            lambda part, i: F.when(i == 0, part).otherwise(F.concat(F.lit(separator), part)))
        return F.filter(parts, lambda part: F.length(part) > 0)

    def level(pieces, separator):
        short = lambda piece: F.when(F.length(piece) <= size, F.array(piece)).otherwise(cut(piece, separator))
        return F.flatten(F.transform(pieces, short))

    return reduce(level, [*[s for s in separators if s], ""], F.array(text))


def _packed(lengths: str, size: int, overlap: int) -> Column:
    """Spans (first, n, start, length) of packed pieces, from a fold over the piece lengths.

    The fold holds the open chunk's first piece, length and start. When the next piece does
    not fit, the chunk closes and the next one reopens with the longest run of its last
    pieces that keeps to ``overlap`` and leaves room for the new piece.
    """
    def kept(at, room):
        # the last pieces before ``at``, from the end, while they fit the room; a piece has a character at least
        nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("len"), F.lit(False).alias("full"))
        if overlap == 0:
            return nothing
        # items are looked up one by one, since a slice would copy the whole array each time
        window = F.greatest(F.lit(1), F.least(at, F.lit(overlap)))
        tail = F.transform(F.sequence(at - 1, at - window, F.lit(-1)), lambda i: F.get(lengths, i))

        def take(held, n):
            full = held["full"] | (held["len"] + n > room)
            grown = lambda name, by: F.when(full, held[name]).otherwise(held[name] + by).alias(name)
            return F.struct(grown("n", 1), grown("len", n), full.alias("full"))

        return F.aggregate(tail, nothing, take)

    span = lambda acc: F.array(F.struct(
        acc["first"].alias("first"), (acc["at"] - acc["first"]).alias("n"), acc["start"].alias("start"), acc["len"].alias("length")))
    state = lambda at, first, start, length, out: F.struct(
        at.alias("at"), first.alias("first"), start.alias("start"), length.alias("len"), out.alias("out"))
    zero = F.lit(0)
    none = F.array().cast("array<struct<first: int, n: int, start: int, length: int>>")

    def step(acc, n):
        at = acc["at"]
        full = (acc["len"] > 0) & (acc["len"] + n > size)
        back = F.when(full, kept(at, F.least(F.lit(overlap), F.lit(size) - n)))
        first = F.when(full, at - back["n"]).otherwise(acc["first"])
        start = F.when(full, acc["start"] + acc["len"] - back["len"]).otherwise(acc["start"])
        length = F.when(full, back["len"]).otherwise(acc["len"]) + n
        out = F.when(full, F.concat(acc["out"], span(acc))).otherwise(acc["out"])
        return state(at + 1, first, start, length, out)

    return F.aggregate(lengths, state(zero, zero, zero, zero, none), step, lambda acc: F.concat(acc["out"], span(acc)))


def chunk_spans(df: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                separators: list[str] = SEPARATORS) -> DataFrame:
    """Row columns beside ``_spans``, the chunks of each text in order: (start, length, chunk_text).

    A span counts characters of the whole text; ``chunk_text`` is it without white space at the
    ends, and may be empty. Null and empty texts have no span.
    """
    carried = [c for c in df.columns if c != text]
    cut = df.select(*carried, F.when(F.length(text) > 0, _pieces(F.col(text), size, separators)).alias("_pieces"))
    # each step reads the one before more than once, which keeps the optimizer from repeating it
    cut = cut.select(*carried, "_pieces", F.transform("_pieces", F.length).alias("_lengths"))
    cut = cut.select(*carried, "_pieces", F.when(F.size("_lengths") > 0, _packed("_lengths", size, overlap)).alias("_at"))
    held = lambda at: F.transform(F.sequence(at["first"], at["first"] + at["n"] - 1), lambda i: F.get("_pieces", i))
    said = lambda at: F.btrim(F.array_join(held(at), ""), F.lit(WHITE_SPACE))
    return cut.select(*carried, F.transform("_at", lambda at: F.struct(
        at["start"].alias("start"), at["length"].alias("length"), said(at).alias("chunk_text"))).alias("_spans"))


def chunk_recursive(df: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                    separators: list[str] = SEPARATORS) -> DataFrame:
    """Chunks cut at the coarsest separator that keeps them within ``size``.

    Small pieces are packed up to ``size``; the next chunk restarts up to ``overlap``
    characters back. Columns only: levels of splits, then a fold over the piece lengths.
    """
    spans = chunk_spans(df, text, size, overlap, separators)
    texts = F.filter(F.transform("_spans", lambda span: span["chunk_text"]), lambda chunk: F.length(chunk) > 0)
    return spans.select(*[c for c in df.columns if c != text], F.posexplode(texts).alias("chunk_no", "chunk_text"))


def chunk_coverage(df: DataFrame, key: str, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(key, covered, longest_fits, in_order): characters that the spans of a text cover together, whether
    no span is longer than ``size``, and whether spans move on and share ``overlap`` characters at most."""
    # texts without spans leave before the cutting: a filter on the spans would be pushed under it and cut each text many times over
    spans = chunk_spans(df.select(key, text).filter(F.length(text) > 0), text, size, overlap)
    fresh = lambda span, i: F.struct(
        span["start"].alias("start"), (span["start"] + span["length"]).alias("end"),
        F.when(i > 0, F.get("_spans", i - 1)["start"] + F.get("_spans", i - 1)["length"]).otherwise(F.lit(0)).alias("before"),
        F.when(i > 0, F.get("_spans", i - 1)["start"]).otherwise(F.lit(-1)).alias("earlier"))
    steps = spans.select(key, "_spans", F.transform("_spans", fresh).alias("_steps"))
    return steps.select(
        key, F.aggregate("_steps", F.lit(0), lambda acc, s: acc + s["end"] - F.greatest(s["start"], s["before"])).alias("covered"),
        F.forall("_spans", lambda s: s["length"] <= size).alias("longest_fits"),
        F.forall("_steps", lambda s: (s["start"] > s["earlier"]) & (s["start"] <= s["before"])
                 & (s["before"] - s["start"] <= overlap) & (s["end"] > s["before"])).alias("in_order"))


def extract_ids(df: DataFrame, key: str, ids: Column) -> DataFrame:
    """Each id once per row key, with its parent (the part before the dot)."""
    found = df.select(key, F.explode(F.array_distinct(ids)).alias("mention"))
    return found.withColumn("parent", F.substring_index("mention", ".", 1))


def eval_set_check(questions: DataFrame, id_pattern: str) -> DataFrame:
    """Rules an evaluation set must meet: non-empty fields, and a reference that cites an id."""
    return gate.gate_rules(questions, [
        gate.expect_not_null("user_input"), gate.expect_match("user_input", r"\S"),
        gate.expect_not_null("reference"), gate.expect_match("reference", id_pattern)])
