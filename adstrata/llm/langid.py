"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

Every text becomes a line of lower-case letters in which one space stands for whatever lies between
them. Spark counts the windows of four symbols of all learned texts; the counts of shorter windows are
those of their distinct continuations. The probabilities of seen windows and the weights of their
contexts are kept by a hash of the window in sorted arrays, and a text gets the language whose model
has the lowest cross-entropy a symbol. One text in twenty is kept out of the counts: on those a score
is fitted to how often the answer is right, and the cross-entropy is found above which it is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.llm.frames import append_columns, column_name, give_back, sliced, stored, without

ORDER = 4
BITS = 16  # a symbol; a window of four fills a 64-bit number
SPACE = 32
# Windows are told apart by so many bits of a hash, which bounds a language's arrays at any input size.
# Windows that meet in a slot share the larger value.
SLOT_BITS = 22
HASH = 0x9E3779B97F4A7C15
# Languages are scored together as long as their arrays stay below this; the others in further passes.
BLOCK_BYTES = 128_000_000
# One learned text in so many is used for calibration only.
CALIBRATION = 20
# Share of a language's own texts that may be rejected.
REJECTED = 0.001
# A language with fewer texts for calibration rejects none.
LEAST_TEXTS = 10
# Bins a unit of the calibrated margin, and their number.
BINS_A_UNIT, MOST_BINS = 4, 400
# Windows that are scored or counted at a time.
BLOCK = 1 << 20

GRAMS = "lang string, gram long, n long"


class Alphabet:
    """Symbols of letters: a letter's code point, folded into 16 bits; 0 for one that was not met yet."""

    def __init__(self) -> None:
        self.codes = np.zeros(0x110000, np.uint16)

    def symbols(self, text: str | None) -> np.ndarray:
        """Lower-case letters with single spaces in between and one at the end; empty without letters."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        codes = self.codes[points]
        if not codes.all():
            for p in np.unique(points[codes == 0]).tolist():
                # No text has surrogates, so their range is free for letters beyond 16 bits.
                folded = p if p < 0x10000 else 0xD800 + p % 2048
                self.codes[p] = folded if chr(p).isalpha() else SPACE
            codes = self.codes[points]
        letter = codes != SPACE
        if not letter.any():
            return np.zeros(0, np.uint64)
        after = np.concatenate([[False], letter[:-1]])
        kept = codes[letter | after].astype(np.uint64)
        return kept if kept[-1] == SPACE else np.append(kept, np.uint64(SPACE))


def windows(symbols: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows that end at each symbol, and the number of the text, in blocks of bounded size."""
    pad = np.full(ORDER - 1, SPACE, np.uint64)
    held, texts, size = [], [], 0
    for number, line in enumerate(symbols):
        line = np.concatenate([pad, line])
        for a in range(0, len(line) - ORDER + 1, BLOCK):
            piece = line[a : a + BLOCK + ORDER - 1]
            gram = piece[: len(piece) - ORDER + 1].copy()
            for k in range(1, ORDER):
                gram = (gram << np.uint64(BITS)) | piece[k : len(piece) - ORDER + 1 + k]
            held.append(gram)
            texts.append(np.full(len(gram), number))
            size += len(gram)
            if size >= BLOCK:
                yield np.concatenate(held), np.concatenate(texts)
                held, texts, size = [], [], 0
    if size:
        yield np.concatenate(held), np.concatenate(texts)


def count_grams(docs: DataFrame) -> DataFrame:
    """Windows of ``text`` by ``lang``, summed up over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, sums = Alphabet(), {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            grams, counts = (np.concatenate(x) for x in zip(*sums[lang]))
            found, at = np.unique(grams, return_inverse=True)
            return found, np.bincount(at, counts).astype(np.int64)

        def out(lang: str) -> pa.RecordBatch:
            grams, counts = merged(lang)
            columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

        for batch in sliced(batches):
            langs = batch.column(0).to_pylist()
            lines = [alphabet.symbols(t) for t in batch.column(1).to_pylist()]
            for lang in set(langs):
                for grams, _ in windows([line for line, own in zip(lines, langs) if own == lang]):
                    sums.setdefault(lang, []).append(np.unique(grams, return_counts=True))
                if sum(len(g) for g, _ in sums.get(lang, ())) > BLOCK:
                    sums[lang] = [merged(lang)]
                    if len(sums[lang][0][0]) > BLOCK // 2:
                        yield out(lang)
                        del sums[lang]
            if sum(len(g) for parts in sums.values() for g, _ in parts) > 4 * BLOCK:
                for lang in sums:
                    yield out(lang)
                sums.clear()
        for lang in sums:
            yield out(lang)
        sums.clear()
        give_back()

    return docs.select("lang", "text").mapInArrow(run, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _low(gram: Column, symbols: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << BITS * symbols) - 1))


def estimate(grams: DataFrame) -> DataFrame:
    """Interpolated Kneser-Ney: ``lang``, ``order``, ``gram``, ``kind`` and ``value``, a logarithm.

    ``kind`` is `gram` for the probability of a window's last symbol after the others, and `context` for
    the share that is left to shorter windows. Order 0 holds the share of a symbol that was never seen.
    """
    counts = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):
        longer = counts[order + 1]
        counts[order] = longer.groupBy("lang", _low(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("n"))
    found, lower = [], None
    for order in range(1, ORDER + 1):
        own = counts[order].withColumn("context", F.shiftrightunsigned("gram", BITS))
        seldom = own.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        # Never nothing or all of a count, also where no window was seen just once or twice.
        ratio = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))
        discount = seldom.select("lang", F.least(F.greatest(ratio, F.lit(0.1)), F.lit(0.9)).alias("d"))
        context = (
            own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).join(discount, "lang")
            .select("lang", "context", "total", "d", (F.col("d") * F.col("kinds") / F.col("total")).alias("left"))
        )
        rows = own.join(context, ["lang", "context"])
        first = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        if order == 1:
            # One symbol more than were seen: those that were not.
            sizes = own.groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("even"))
            rows = rows.join(sizes, "lang").withColumn("p", first + F.col("left") * F.col("even"))
            nothing = context.join(sizes, "lang").select("lang", F.lit(0).alias("order"), F.lit(0).cast("long").alias("gram"), F.lit("gram").alias("kind"), F.log(F.col("left") * F.col("even")).alias("value"))
            found.append(nothing)
        else:
            short = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q"))
            rows = rows.withColumn("suffix", _low(F.col("gram"), order - 1)).join(short, ["lang", "suffix"])
            rows = rows.withColumn("p", first + F.col("left") * F.col("q"))
            found.append(context.select("lang", F.lit(order).alias("order"), F.col("context").alias("gram"), F.lit("context").alias("kind"), F.log("left").alias("value")))
        lower = stored(rows.select("lang", "gram", "p"), f"langid-{order}")
        found.append(lower.select("lang", F.lit(order).alias("order"), "gram", F.lit("gram").alias("kind"), F.log("p").alias("value")))
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole


def slots(grams: np.ndarray) -> np.ndarray:
    """Hashes of windows, of SLOT_BITS bits."""
    mixed = grams.astype(np.uint64)
    for _ in range(2):
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(HASH)
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)


@dataclass
class Arrays:
    """The model of one language: sorted slots and values for each order and kind."""

    lang: str
    tables: dict[tuple[int, str], tuple[np.ndarray, np.ndarray]]
    nothing: float

    def find(self, order: int, kind: str, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which windows are known, and their values."""
        if (order, kind) not in self.tables:
            return np.zeros(len(grams), bool), np.zeros(len(grams))
        known, values = self.tables[order, kind]
        wanted = slots(grams)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return known[at] == wanted, values[at]

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each window's last symbol after the others."""
        p = np.full(len(grams), self.nothing)
        for order in range(1, ORDER + 1):
            own = grams & np.uint64((1 << BITS * order) - 1)
            if order > 1:
                seen, left = self.find(order, "context", own >> np.uint64(BITS))
                p += np.where(seen, left, 0.0)
            seen, value = self.find(order, "gram", own)
            p = np.where(seen, value, p)
        return p


@dataclass
class Model:
    """Blocks of languages to be scored together, and the calibration."""

    blocks: list[list[Arrays]]
    slope: float
    offset: float
    # Mean cross-entropy of a language's own texts, and how far above it a text may be.
    limits: dict[str, tuple[float, float]]


def _blocks(entries: DataFrame) -> list[list[Arrays]]:
    """Sorted arrays by language, packed in blocks; the driver holds at most 2 ** SLOT_BITS slots a table."""
    kinds = T.StructType([f for f in entries.schema.fields if f.name != "gram"] + [T.StructField("slot", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_numpy().view(np.uint64)
            slot = pa.array(slots(grams).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kinds.fields[:-1]), slot], names=kinds.names)

    rows = entries.mapInArrow(run, kinds).groupBy("lang", "order", "kind", "slot").agg(F.max("value").cast("float").alias("value"))
    rows = stored(rows, "langid-slots")
    blocks, room = [], 0
    for lang, n in sorted(rows.groupBy("lang").count().collect()):
        mine = rows.filter(F.col("lang") == lang).select("order", "kind", F.col("slot").cast("int"), "value")
        found = mine.orderBy("order", "kind", "slot").toArrow()
        order, kind = found.column("order").to_numpy(), np.array(found.column("kind").to_pylist())
        slot, value = found.column("slot").to_numpy().astype(np.uint32), found.column("value").to_numpy()
        tables, nothing = {}, 0.0
        for key in sorted(set(zip(order.tolist(), kind.tolist()))):
            at = (order == key[0]) & (kind == key[1])
            if key[0] == 0:
                nothing = float(value[at][0])
            else:
                tables[key] = slot[at], value[at]
        if not blocks or room + 8 * n > BLOCK_BYTES:
            blocks.append([])
            room = 0
        blocks[-1].append(Arrays(lang, tables, nothing))
        room += 8 * n
    return blocks


BEST = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("cross_entropy", T.DoubleType()),
    T.StructField("margin", T.DoubleType()),
    T.StructField("n_symbols", T.LongType()),
]


def _scored(docs: DataFrame, text: str, blocks: list[list[Arrays]]) -> DataFrame:
    """Add the best language, its cross-entropy, the distance of the next best, and the number of symbols."""
    names = [f.name for f in BEST]
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in BEST]
    docs = docs.select(*without(docs, names), *empty)
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def start(shared=shared):
            alphabet = Alphabet()

            def work(texts, lang, entropy, margin, n_symbols):
                lines = [alphabet.symbols(t) for t in texts.to_pylist()]
                models = shared.value
                sums = np.zeros((len(models), len(lines)))
                for grams, number in windows(lines):
                    kinds, at = np.unique(grams, return_inverse=True)
                    for sum_, model in zip(sums, models):
                        sum_ -= np.bincount(number, model.log_p(kinds)[at], len(lines))
                langs, entropies, margins, sizes = [], [], [], []
                for i, before in enumerate(zip(lang.to_pylist(), entropy.to_pylist(), margin.to_pylist())):
                    size = len(lines[i])
                    sizes.append(size)
                    ways = [(sums[m, i] / size, models[m].lang) for m in range(len(models))] if size else []
                    if before[0] is not None:
                        ways.append((before[1], before[0]))
                        if before[2] is not None:  # the next best of the languages before
                            ways.append((before[1] + before[2], before[0]))
                    ways.sort()
                    langs.append(ways[0][1] if ways else None)
                    entropies.append(ways[0][0] if ways else None)
                    margins.append(ways[1][0] - ways[0][0] if len(ways) > 1 else None)
                return [pa.array(langs, pa.string()), pa.array(entropies, pa.float64()), pa.array(margins, pa.float64()), pa.array(sizes, pa.int64())]

            return work

        docs = append_columns(docs, [text, "lang_pred", "cross_entropy", "margin", "n_symbols"], BEST, start)
    return docs


def _strength(margin: Column, n_symbols: Column) -> Column:
    """What the score depends on: the margin, worth more in longer texts."""
    return F.coalesce(margin, F.lit(0.0)) * F.sqrt(n_symbols)


def _fit(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (strength, right, all), by Newton's steps.

    One right and one wrong text at every end of the scale keep it finite where all are right.
    """
    x = np.array([b[0] for b in bins] + [0.0, MOST_BINS / BINS_A_UNIT])
    right = np.array([b[1] for b in bins] + [0.5, 1.0])
    total = np.array([b[2] for b in bins] + [1.0, 1.0])
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (right - total * p) - 1e-3 * w
        curve = design.T @ (design * (total * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def train(docs: DataFrame, lang: str = "lang", text: str = "text", record: str = "doc_id") -> Model:
    """Models of all languages of ``docs``, counted over all of their rows but those kept for calibration.

    Rows with a null language or text teach nothing. Calibration takes one row in CALIBRATION by a hash
    of ``record``, all of them whatever their number; a language that occurs in those alone is not
    learned. An empty table gives a model without languages.
    """
    names = {"lang": lang, "text": text, "record": record}
    docs = docs.select(*[F.col(column_name(docs, c)).alias(name) for name, c in names.items()])
    docs = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    apart = F.pmod(F.xxhash64("record"), F.lit(CALIBRATION)) == 0
    grams = stored(count_grams(docs.filter(~apart)), "langid-grams")
    blocks = _blocks(estimate(grams))
    if not blocks:
        return Model([], 0.0, 0.0, {})
    tried = stored(_scored(docs.filter(apart).select("lang", "text"), "text", blocks).drop("text").filter("n_symbols > 0"), "langid-calibration")
    bin_ = F.least(F.floor(_strength(F.col("margin"), F.col("n_symbols")) * BINS_A_UNIT), F.lit(MOST_BINS))
    bins = tried.groupBy(bin_.alias("bin")).agg(F.count_if(F.col("lang") == F.col("lang_pred")).alias("right"), F.count("*").alias("all"))
    slope, offset = _fit([((b + 0.5) / BINS_A_UNIT, right, n) for b, right, n in bins.collect()])
    own = tried.filter("lang = lang_pred")
    means = own.groupBy("lang").agg(F.avg("cross_entropy").alias("mean"))
    above = (F.col("cross_entropy") - F.col("mean")) * F.sqrt("n_symbols")
    # The quantile of few texts says little: four standard deviations are allowed in any case.
    far = F.greatest(F.percentile_approx(above, 1 - REJECTED, 10_000), F.avg(above) + 4 * F.stddev(above))
    limits = own.join(means, "lang").groupBy("lang", "mean").agg(far.alias("above"), F.count("*").alias("n"))
    limits = limits.filter(F.col("n") >= LEAST_TEXTS)
    return Model(blocks, slope, offset, {row[0]: (row[1], row[2]) for row in limits.collect()})


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``accepted``, ``cross_entropy``, ``margin`` and ``n_symbols``.

    ``lang_pred`` is the language of the lowest cross-entropy a symbol (of equal ones the first by name),
    null for a null text and one without letters, and with an empty model. ``score`` estimates how
    likely it is right; it is 0 without a language and halved for a rejected text, one that is further
    above the mean cross-entropy of the language than all but REJECTED of its own texts are. Repeated rows get equal
    answers; columns of the same names are replaced, others are kept. Only ``text`` decides.
    """
    added = ["score", "accepted", *[f.name for f in BEST]]
    text = column_name(docs, text)
    found = _scored(docs, text, model.blocks)
    strength = _strength(F.col("margin"), F.col("n_symbols"))
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-(strength * model.slope + model.offset)))
    fits = F.lit(True)
    for lang, (mean, above) in sorted(model.limits.items()):
        far = (F.col("cross_entropy") - mean) * F.sqrt("n_symbols") > above
        fits = F.when((F.col("lang_pred") == lang) & far, False).otherwise(fits)
    known = F.col("lang_pred").isNotNull()
    accepted = F.when(known, fits).otherwise(False)
    return found.withColumn("accepted", accepted).withColumn(
        "score", F.when(~known, 0.0).when(F.col("accepted"), chance).otherwise(chance / 2)
    ).select(*without(docs, added), "lang_pred", "score", "accepted", "cross_entropy", "margin", F.coalesce("n_symbols", F.lit(0)).cast("long").alias("n_symbols"))
