"""Licence phrases word by word, and notices against fuzzy matching of whole texts."""

import random
import re

import regex

from adstrata.llm import licenses, queries

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return words, sorted(places)


def fuzzy(words):
    joined = " ".join(words)
    found = {}
    for label, notice in licenses.NOTICES:
        edits = licenses.edits_allowed(notice)
        match = regex.search(rf"(?b)(?<![^ ])(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?![^ ])", joined)
        if match:
            similarity = 1 - sum(match.fuzzy_counts) / len(notice)
            found[label] = max(found.get(label, 0), similarity)
    return found


def texts():
    rnd = random.Random(11)
    made = []
    for _, notice in licenses.NOTICES * 6:
        letters = list(notice)
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(letters))
            kind = rnd.choice("sdi")
            letters[at : at + (kind != "i")] = [] if kind == "d" else [rnd.choice("abcdez ")]
        before = " ".join(rnd.choice(["alpha", "the", "mit", "license", "public"]) for _ in range(rnd.randint(0, 9)))
        made.append(f"{before}, {''.join(letters)}. {before}")
    return [None, "", "MIT License mit-license\nApache\tLICENSE general public license", "mit license mit license", "é mit  license ß", "license " * 5_000, *made]


def test_scan(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())] + [(1, "", "x", "y"), (None, None, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Labels string, n_words string").repartition(2)
    found = licenses.scan(df).collect()
    assert len(found) == len(rows)
    for row in found:
        words, places = plain(row.text)
        starts = [p for p, _ in places]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        base = {label for _, label in places}
        expected = fuzzy(words)
        assert row.base_labels == ",".join(sorted(base))
        assert row.labels == ",".join(sorted(base | set(expected))), row.text
        best = 1.0 if places else max(expected.values(), default=0.0)
        assert abs(row.score - best) < 1e-9, row.text


def test_spans_and_edits(spark):
    df = spark.createDataFrame([(1, "Foo bar: Licenced under the Apache Licence, Version 2.0! More.")], "doc_id long, text string")
    row = licenses.scan(df).first()
    assert [(s.label, s.first_word, s.last_word, s.edits) for s in row.spans] == [("apache", 2, 9, 2)]
    assert row.base_labels == "" and row.labels == "apache" and 0.9 < row.score < 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(diagonal + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def brute_force(words, notice):
    """Stretches of words by their edits, the best first, without those that overlap a better one."""
    size, edits = len(notice.split()), licenses.edits_allowed(notice)
    tried = [(distance(" ".join(words[i : i + size]), notice), i) for i in range(len(words) - size + 1)]
    taken = []
    for n, i in sorted(t for t in tried if t[0] <= edits):
        if all(abs(i - j) >= size for j, _ in taken):
            taken.append((i, n))
    return sorted((i, i + size - 1, n) for i, n in taken)


def test_adjacent_notices():
    """Worse copies of a notice are found beside better ones, in any order."""
    rnd = random.Random(5)
    for label, notice in [n for n in licenses.NOTICES if licenses.edits_allowed(n[1])]:
        scanner = licenses.Scanner([(label, notice)])
        for _ in range(6):
            words = []
            for _ in range(rnd.randint(2, 5)):
                letters = list(notice)
                inside = [i for i in range(1, len(letters) - 1) if " " not in letters[i - 1 : i + 2]]
                for at in rnd.sample(inside, rnd.randint(0, licenses.edits_allowed(notice))):
                    letters[at] = "q"
                words += "".join(letters).split() + ["and"] * rnd.randint(0, 1)
            expected = brute_force(words, notice)
            assert len(expected) > 1
            assert [h[1:4] for h in scanner.scan(" ".join(words))] == expected, words
    undr = "released undr the mit license released under the mit license"
    assert [h[1:4] for h in licenses.Scanner(licenses.NOTICES[:1]).scan(undr)] == [(0, 4, 1), (5, 9, 0)]


def test_pieces_cover_the_notice():
    for _, notice in licenses.NOTICES:
        cut = licenses.pieces(notice)
        assert len(cut) == licenses.edits_allowed(notice) + 1
        assert "".join(p for _, p in cut) == notice
        assert all(notice[a : a + len(p)] == p and len(p) >= 8 for a, p in cut)


def test_nothing(nothing):
    assert licenses.scan(nothing).collect() == []


def test_query(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op5_licenses(spark, folder).collect():
        words, places = plain(docs[row.doc_id])
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert 0 <= row.score <= 1
