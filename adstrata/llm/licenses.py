"""Licence scans by fuzzy search for short notices.

A notice that occurs with at most k edits, cut into k + 1 pieces, has one piece unchanged. All pieces
of all notices form one automaton of exact strings; each hit says where its notice may lie, and only
there the regex module's bounded-error matching verifies it, counts its edits, and reports its span.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adstrata.llm.frames import append_columns, raw_texts

# Phrases whose places are counted word by word, and their labels.
PHRASES = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}
# Wording of public notices, as words between single blanks.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("all-rights-reserved", "all rights reserved"),
]
# A notice may have one edit for so many characters, less one, so that pieces have half as many.
EDIT_EVERY = 12
MOST_EDITS = 8

NOT_WORD = bytes(c for c in range(128) if not chr(c).isalnum())
SPLITTING = bytes.maketrans(NOT_WORD, b" " * len(NOT_WORD))

SPAN = T.StructType(
    [
        T.StructField("label", T.StringType(), False),
        T.StructField("first_word", T.LongType(), False),
        T.StructField("last_word", T.LongType(), False),
        T.StructField("edits", T.IntegerType(), False),
        T.StructField("similarity", T.DoubleType(), False),
    ]
)


def edits_allowed(notice: str) -> int:
    return max(0, min(MOST_EDITS, len(notice) // EDIT_EVERY - 1))


def pieces(notice: str) -> list[tuple[int, str]]:
    """One piece more than edits are allowed, with their offsets."""
    n = edits_allowed(notice) + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().translate(SPLITTING).split()


def base_places(words: list[bytes], phrases: dict = PHRASES) -> list[tuple[int, str]]:
    """Where the phrases stand, by the index of their first word."""
    ends = defaultdict(list)
    for phrase, label in phrases.items():
        ends[phrase[-1].encode()].append(([w.encode() for w in phrase], label))
    found = []
    for end, ending in ends.items():
        at = -1
        for _ in range(words.count(end)):
            at = words.index(end, at + 1)
            for phrase, label in ending:
                begin = at - len(phrase) + 1
                if begin >= 0 and words[begin : at + 1] == phrase:
                    found.append((begin, label))
    return sorted(found)


class Scanner:
    """Finds notices in words joined by blanks."""

    def __init__(self, notices: list[tuple[str, str]] = NOTICES):
        self.notices = [(label, text, edits_allowed(text)) for label, text in notices]
        owners = defaultdict(list)
        for k, (_, text, _) in enumerate(self.notices):
            for offset, piece in pieces(text):
                owners[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owned in owners.items():
            self.automaton.add_word(piece, (len(piece), owned))
        self.automaton.make_automaton()
        # A notice stands at word limits; the best match is that with the fewest edits.
        self.fuzzy = [
            regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(text, literal_spaces=True)}){{e<={edits}}}(?![^ ])")
            for _, text, edits in self.notices
        ]

    def windows(self, joined: str) -> dict[int, list[list[int]]]:
        """Where each notice may lie, overlapping stretches merged."""
        found: dict[int, list[list[int]]] = defaultdict(list)
        for end, (size, owned) in self.automaton.iter(joined):
            for k, offset in owned:
                _, text, edits = self.notices[k]
                begin = end + 1 - size - offset - edits - 1
                stop = begin + len(text) + 2 * edits + 2
                found[k].append([max(0, begin), stop])
        for k, spans in found.items():
            spans.sort()
            merged = spans[:1]
            for a, b in spans[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            found[k] = merged
        return found

    def matches(self, k: int, joined: str, a: int, b: int) -> list[regex.Match]:
        """Matches of a notice in a stretch: the best one, then those before and behind it."""
        found, left = [], [(a, b)]
        while left:
            a, b = left.pop()
            match = self.fuzzy[k].search(joined, a, b)
            if match:
                found.append(match)
                left += [(a, match.start()), (match.end(), b)]
        return found

    def scan(self, joined: str) -> list[tuple[str, int, int, int, float]]:
        """Label, first and last word, edits and similarity of each notice found."""
        hits = []
        for k, spans in self.windows(joined).items():
            label, text, _ = self.notices[k]
            for a, b in spans:
                for match in self.matches(k, joined, a, b):
                    edits = sum(match.fuzzy_counts)
                    begin = match.start() + len(match.group()) - len(match.group().lstrip(" "))
                    first = joined.count(" ", 0, begin)
                    last = first + match.group().strip(" ").count(" ")
                    hits.append((label, first, last, edits, 1 - edits / len(text)))
        return sorted(hits)


def scan(df: DataFrame, text: str = "text", notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Add the licences of ``text``: counts, places, labels, score and the spans of notices.

    New columns: ``n_words``; ``n_base``, the places of ``PHRASES``; ``first_word`` and ``last_word``,
    the smallest and largest start among them, null without any; ``base_labels`` and ``labels``, which
    has those of the notices too, both distinct, sorted and comma-joined; ``score``, 1 where a phrase
    stands, else the similarity of the best notice, else 0; ``spans``, one for each notice found. A
    null text counts as empty. Rows stay as they are, repeated ones too; columns of the new names
    are replaced.
    """
    kinds = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long"}
    fields = [T.StructField(n, T.LongType(), n.endswith("_word")) for n in kinds]
    fields += [T.StructField(n, T.StringType(), False) for n in ("base_labels", "labels")]
    fields += [T.StructField("score", T.DoubleType(), False), T.StructField("spans", T.ArrayType(SPAN, False), False)]

    def start():
        scanner = Scanner(notices)
        arrow_span = pa.struct(
            [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())]
        )
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(arrow_span)]

        def work(column: pa.Array) -> list[pa.Array]:
            rows = []
            for raw in raw_texts(column):
                words = words_of(raw or b"")
                places = base_places(words)
                hits = scanner.scan(b" ".join(words).decode("utf-8", "replace"))
                base = {label for _, label in places}
                labels = base | {h[0] for h in hits}
                score = 1.0 if places else max((h[4] for h in hits), default=0.0)
                starts = [p for p, _ in places]
                spans = [dict(zip(("label", "first_word", "last_word", "edits", "similarity"), h, strict=True)) for h in hits]
                rows.append(
                    (len(words), len(places), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted(base)), ",".join(sorted(labels)), score, spans)
                )
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
            return [pa.array(c, t) for c, t in zip(columns, types, strict=True)]

        return work

    return append_columns(df, [text], fields, start)
