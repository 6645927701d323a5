"""Removal of personal data, and of words that give it away.

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers: the protected entities.
Corpus co-occurrence then says how much a word reveals an entity. With N documents, e in c(e) of them,
t in c(t), and t near e in c(e,t), the pointwise mutual information of t and e as a share of e's
own information is

    disclosure = ln(N c(e,t) / (c(e) c(t))) / ln(N / c(e)) = 1 + ln(c(e,t) / c(t)) / ln(N / c(e))

so 1 means that whoever reads t knows e. Words above the thresholds are removed or generalised
wherever they stand, unless chance explains them: of texts that hold e with probability p, a share x
among n does so at most with probability exp(-n D(x, p)), D being the relative entropy (Chernoff).
A rare entity thus needs few texts, a common one more. Everything is built-in column functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.llm.frames import column_name, computed_once, stored, without

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# The patterns match as written plainly, but never start inside a run they have given up, which
# keeps them linear: \G lets a match begin where the one before it ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a match, quick to look for.
HINTS = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){13}",
    "phone": r"\+[0-9]",
}
TERM_PATTERN = r"[\p{L}\p{M}\p{N}]++"


@dataclass(frozen=True)
class Disclosure:
    """Words within ``reach`` words of an entity count if ``chance`` explains them no better than that."""

    reach: int = 5
    chance: float = 0.01
    generalise: float = 0.85
    remove: float = 0.95
    # Up to so many flagged words, or documents' words, are broadcast; beyond that they are shuffled.
    broadcast_rows: int = 100_000


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often and deep inside ``use`` has it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(lengths: Column) -> Column:
    """Sum of the lengths before each place, in blocks so that long arrays stay quick."""
    block = 64
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b)
    of_block = lambda k: F.floor(k / block).cast("int")

    def places(held: Column, bases: Column) -> Column:
        return F.transform(
            held, lambda _, k: F.get(bases, of_block(k)) + total(F.slice(held, of_block(k) * block + 1, k % block))
        )

    def from_blocks(held: Column) -> Column:
        blocks = F.sequence(F.lit(0), of_block(F.size(held)))
        sums = F.transform(blocks, lambda j: total(F.slice(held, j * block + 1, block)))
        bases = lambda s: F.transform(s, lambda _, j: total(F.slice(s, 1, j)))
        return _bound(_bound(sums, bases), lambda b: places(held, b))

    return _bound(lengths, from_blocks)


def _matches(text: str, pattern: str, hint: str | None, as_named: str) -> tuple[Column, Column]:
    """Matches of a pattern and the pieces between them, both empty where the hint is missing."""
    nothing = F.array().cast("array<string>")
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    if hint is None:
        return found.alias(f"_{as_named}"), pieces.alias(f"_{as_named}_between")
    there = F.col(text).rlike(hint)
    return (
        F.when(there, found).otherwise(nothing).alias(f"_{as_named}"),
        F.when(there, pieces).otherwise(nothing).alias(f"_{as_named}_between"),
    )


def _places(name: str) -> Column:
    """Spans of matches: value, start, end in code points."""
    found, between = F.col(f"_{name}"), F.col(f"_{name}_between")
    lengths = F.zip_with(
        found, F.slice(between, 1, F.size(found)), lambda m, b: F.char_length(m) + F.char_length(b)
    )
    return F.zip_with(
        F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(m.alias("value"), F.char_length(b).alias("gap"))),
        _before(lengths),
        lambda m, before: F.struct(
            F.lit(name).alias("kind"),
            (before + m["gap"]).alias("start"),
            (before + m["gap"] + F.char_length(m["value"])).alias("end"),
            m["value"].alias("value"),
        ),
    )


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(backwards, i + 1, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(i % 2 == 0, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add) % 10 == 0


def _validity(kind: str):
    return lambda span: _valid(kind, span)


def _valid(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        small = lambda part: F.ltrim(part, F.lit("0")).rlike("^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.when(F.char_length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(F.translate(value, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def base_spans(df: DataFrame, text: str, spans: str = "spans") -> DataFrame:
    """Add the entities of a text column without nulls: kind, start, end (code points), value.

    They are ordered by kind, as listed in ``KINDS``, then by start; kinds may overlap.
    """
    kept = without(df, [spans])
    columns = [c for kind in KINDS for c in _matches(text, PATTERNS[kind], HINTS[kind], kind)]
    found = df.select(*kept, *columns)
    found = found.select(*kept, *[_places(kind).alias(f"_{kind}_at") for kind in KINDS])
    every = F.concat(*[F.filter(f"_{kind}_at", _validity(kind)) for kind in KINDS])
    return computed_once(found, kept, {spans: every})


def _terms(text: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0)), F.lower)


def _contexts(text: Column, span: Column, reach: int) -> Column:
    """The ``reach`` words before a span and after it, however far away they stand."""

    def before(width: Column) -> Column:
        return _terms(F.substring(text, span["start"] - width + 1, width))

    def after(width: Column) -> Column:
        return _terms(F.substring(text, span["end"] + 1, width))

    def side(words: Callable[[Column], Column], size: Column) -> Column:
        # A stretch with more words than asked for has them whole: only its last one can be cut.
        def within(width: int, longer: Column) -> Column:
            enough = lambda held: F.when((F.size(held) > reach) | (size <= width), held).otherwise(longer)
            return _bound(words(F.least(size, F.lit(width))), enough)

        return within(40 * reach, within(3_200 * reach, words(size)))

    left = side(before, span["start"])
    right = side(after, F.char_length(text) - span["end"])
    last = _bound(left, lambda held: F.slice(held, F.greatest(F.size(held) - reach, F.lit(0)) + 1, reach))
    return F.array_distinct(F.concat(last, F.slice(right, 1, reach)))


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.lower(F.translate(span["value"], " ().-", "")))


def _evidence(share: Column, by_chance: Column) -> Column:
    """Negative logarithm of how likely chance brings ``texts`` of a word's texts, this share, near an entity."""
    others = F.when(share < 1, (1 - share) / share * F.log((1 - share) / (1 - by_chance))).otherwise(0.0)
    return F.when(share > by_chance, F.col("texts") * (F.log(share / by_chance) + others)).otherwise(0.0)


def disclosing_terms(plain: DataFrame, docs: DataFrame, settings: Disclosure) -> DataFrame:
    """Words that reveal an entity of ``_spans``, with what is to be done: ``term``, ``action``.

    ``plain`` are the documents without their spans. Counts are of all documents, copies included;
    the evidence for a pair of word and entity is of different texts, so that copies add nothing to it.
    """
    named = docs.filter(F.size("_spans") > 0).withColumn("_named", F.transform("_spans", _entity))
    # Rows hold what stands around one entity and not the text, which may have thousands of them.
    occurring = F.transform(
        F.array_distinct("_named"),
        lambda e: F.struct(e.alias("entity"), F.lit(True).alias("first"), F.array().cast("array<string>").alias("terms")),
    )
    surrounded = F.transform(
        "_spans",
        lambda s: F.struct(
            _entity(s).alias("entity"), F.lit(False).alias("first"), _contexts(F.col("_text"), s, settings.reach).alias("terms")
        ),
    )
    near = computed_once(named, ["_digest"], {"_near": F.concat(occurring, surrounded)})
    near = near.select("_digest", F.explode("_near").alias("_one")).select("_digest", "_one.*")
    near = stored(near, "pii-contexts")
    all_texts = plain.groupBy("_digest").agg(F.count("*").alias("copies"))
    n_docs, n_texts = all_texts.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")).first()
    # Documents of each entity, counted text by text.
    occurs = stored(
        near.filter("first").groupBy("entity", "_digest").agg(F.count("*").alias("copies")), "pii-entities"
    )
    entities = occurs.groupBy("entity").agg(F.sum("copies").alias("c_e"), F.count("*").alias("texts_e"))
    pairs = (
        near.select("entity", "_digest", F.explode("terms").alias("term"))
        .groupBy("entity", "term", "_digest")
        .agg(F.lit(1).alias("one"))
        .join(occurs, ["entity", "_digest"])
        .groupBy("entity", "term")
        .agg(F.sum("copies").alias("c_et"), F.count("*").alias("texts"))
        .join(entities, "entity")
        .filter(F.col("c_e") < n_docs)
    )
    pairs = stored(pairs, "pii-pairs")
    # Every word is counted over all documents, then looked up; the counts are one row a word.
    counts = (
        plain.select(F.explode(F.array_distinct(_terms("_text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("c_t"))
    )
    counts = stored(counts.join(pairs.select("term").distinct(), "term"), "pii-counts")
    share = F.col("c_et") / F.col("c_t")
    judged = (
        counts.join(pairs, "term")
        .withColumn("disclosure", 1 + F.log(share) / F.log(F.lit(n_docs) / F.col("c_e")))
        .filter(F.col("disclosure") >= settings.generalise)
        .filter(_evidence(share, F.col("texts_e") / F.lit(n_texts)) >= -math.log(settings.chance))
        .groupBy("term")
        .agg(F.max("disclosure").alias("disclosure"))
    )
    action = F.when(F.col("disclosure") >= settings.remove, "remove").otherwise("generalise")
    return judged.select("term", action.alias("action"))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """Marked for a broadcast if it is known to have few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def find(df: DataFrame, text: str = "text", spans: str = "spans", settings: Disclosure | None = None) -> DataFrame:
    """Add ``spans``: entities and revealing words as kind, start, end (code points) and action.

    Entities come first, ordered by kind and start; words follow as kind ``term``, without those that
    overlap an entity. A null text has no spans. Rows stay as they are, repeated ones too; a column
    of the new one's name is replaced. An empty table stays empty.
    """
    settings = settings or Disclosure()
    source = column_name(df, text)
    kept = without(df, [spans, "_text", "_digest", "_spans", "_flagged", "_actions"])
    content = F.coalesce(F.col(source), F.lit(""))
    docs = df.select(*kept, *([] if source in kept else [F.col(source)]), content.alias("_text"), F.md5(content).alias("_digest"))
    plain, docs = docs, base_spans(docs, "_text", "_spans")
    flagged = stored(disclosing_terms(plain, docs, settings), "pii-terms")
    if flagged.isEmpty():
        return docs.select(*kept, _with_actions(F.col("_spans")).alias(spans))
    words = plain.select("_digest", F.explode(F.array_distinct(_terms("_text"))).alias("term"))
    hits = words.join(_bounded(flagged, settings.broadcast_rows), "term").distinct()
    # At most as many words as the text has.
    hits = hits.groupBy("_digest").agg(F.collect_list(F.struct("term", "action")).alias("_hits"))
    hits = hits.select("_digest", F.col("_hits.term").alias("_flagged"), F.col("_hits.action").alias("_actions"))
    hits = stored(hits, "pii-hits")
    held = docs.join(_bounded(hits, settings.broadcast_rows), "_digest", "left")
    names = [*kept, "_spans", "_flagged", "_actions"]
    found = held.select(*names, *_matches_where("_text", F.col("_actions").isNotNull()))
    found = found.select(*names, _places("term").alias("_places"))
    revealing = F.filter(
        F.transform(
            "_places",
            lambda p: F.struct(
                p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"),
                F.get("_actions", F.array_position("_flagged", F.lower(p["value"])).cast("int") - 1).alias("action"),
            ),
        ),
        lambda p: p["action"].isNotNull() & ~F.exists("_spans", lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"])),
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int,action:string>>")
    return found.select(*kept, F.concat(_with_actions(F.col("_spans")), F.coalesce(revealing, none)).alias(spans))


def _matches_where(text: str, there: Column) -> list[Column]:
    nothing = F.array().cast("array<string>")
    return [
        F.when(there, F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0))).otherwise(nothing).alias("_term"),
        F.when(there, F.split(text, TERM_PATTERN, -1)).otherwise(nothing).alias("_term_between"),
    ]


def _with_actions(spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit("generalise").alias("action")
        ),
    )


def sanitise(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace what the spans of ``find`` cover: entities and generalised words by their kind, the rest by nothing.

    Overlapping spans are one, named after the first. A null text stays null.
    """
    source = column_name(df, text)
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"),
                F.when(s["action"] == "remove", "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">"))).alias("put"),
            ),
        )
    )
    merged = F.aggregate(
        ordered,
        F.array().cast("array<struct<start:int,end:int,put:string>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(F.concat(done, F.array(s)), F.greatest(F.size(done), F.lit(1)))["end"] > s["start"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.transform(
                    F.slice(done, F.greatest(F.size(done), F.lit(1)), 1),
                    lambda d: F.struct(d["start"].alias("start"), F.greatest(d["end"], s["end"]).alias("end"), d["put"].alias("put")),
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    held = df.withColumn("_merged", merged)
    body = F.transform(
        "_merged",
        lambda m, k: F.concat(
            F.substring(source, _end_before("_merged", k) + 1, m["start"] - _end_before("_merged", k)), m["put"]
        ),
    )
    last = _end_before("_merged", F.size("_merged"))
    rest = F.substring(source, last + 1, F.char_length(source))
    clean = F.when(F.size("_merged") > 0, F.concat(F.array_join(body, ""), rest)).otherwise(F.col(source))
    return held.withColumn(source, clean).drop("_merged")


def _end_before(merged: str, k: Column) -> Column:
    return F.coalesce(F.get(merged, k - 1)["end"], F.lit(0))
