"""Token counts by a compiled finite-state tokenizer.

Two deterministic transducers stand behind each other. The *splitter* reads characters by class and
marks where pieces begin: its few states say what kind of piece is open, and a transition may mark
its own character or the one before, which settles what the pattern decides by looking ahead. The
*counter* reads the characters themselves. Its states are the beginnings of pieces, its transitions
lead from one to the next by a character, and the transition that a new piece takes out of a state is
annotated with the number of tokens the merges leave of the piece that ends there. Transitions are
compiled when they are first needed; merge rounds run only for annotations that are not there yet.

The characters of many documents form one string, cut into chunks of equal length. The splitter's map
from every entry state to its exit state is computed for all chunks side by side; a parallel prefix
scan composes the maps, which gives each chunk its true entry state. A second run emits the marks.
The counter's map of a chunk is constant from the chunk's first mark on, since a piece begins anew
there: all chunks run from their first marks side by side, which gives exit states, and then the
characters before the first marks run from the exit states of the chunks before. The emitted counts
are composed by a prefix sum and read off at the ends of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from adstrata.llm import bpe, vocab
from adstrata.llm.frames import append_columns, slices

CHUNK = 2048
# Steps after which entry states are tried for having met in one state.
MEET = 48
END_MARK = "\ud800"  # no valid text holds it
# A longer piece is one transition of its own, annotated each time it is met: its beginnings get no states.
LONGEST = 256
# States of the counter in a worker's table; a table that has more is emptied before the next slice.
STATES = 2_000_000
START = 0

# Classes of characters. The letters that can stand in a contraction have classes of their own.
END, LETTER, DIGIT, OTHER, QUOTE, BLANK, WHITE, STMD, R, V, L, E = range(12)
N_CLASSES = 12
LETTERS = (LETTER, STMD, R, V, L, E)
# States: what the characters since the last mark are.
FRESH, WORD, NUMBER, SIGNS, ONE_BLANK, ONE_WHITE, MORE_BLANK, MORE_WHITE, QUOTED, QUOTED_RV, QUOTED_L = range(11)
N_STATES = 11
HERE, BEFORE = 1, 2  # marks: a piece begins at this character, at the one before


def _step(state: int, kind: int) -> tuple[int, int]:
    """Next state and marks of the splitter."""
    if state == QUOTED and kind == STMD:
        return FRESH, 0
    if state == QUOTED and kind in (R, V):
        return QUOTED_RV, 0
    if state == QUOTED and kind == L:
        return QUOTED_L, 0
    if (state == QUOTED_RV and kind == E) or (state == QUOTED_L and kind == L):
        return FRESH, 0
    if state in (QUOTED_RV, QUOTED_L):  # no contraction: its letter has begun a word
        following, marks = _step(WORD, kind)
        return following, marks | BEFORE
    if kind == END:
        return FRESH, 0
    if kind in (BLANK, WHITE):
        if state in (ONE_BLANK, ONE_WHITE, MORE_BLANK, MORE_WHITE):
            return (MORE_BLANK if kind == BLANK else MORE_WHITE), 0
        return (ONE_BLANK if kind == BLANK else ONE_WHITE), HERE
    opened = WORD if kind in LETTERS else NUMBER if kind == DIGIT else SIGNS
    marks = BEFORE if state in (MORE_BLANK, MORE_WHITE) else 0
    if state in (ONE_BLANK, MORE_BLANK):  # the blank before belongs to the piece
        return opened, marks
    if state == opened or (state == QUOTED and opened == SIGNS):
        return opened, 0
    return (QUOTED if kind == QUOTE else opened), marks | HERE


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states and marks, at state * N_CLASSES + class."""
    steps = [_step(s, k) for s in range(N_STATES) for k in range(N_CLASSES)]
    return np.array([s for s, _ in steps], np.uint8), np.array([m for _, m in steps], np.uint8)


def character_classes(path: str) -> np.ndarray:
    """Class of every code point, as the library's own splitter treats it.

    Code points above the last plane of letters are neither letters, digits nor white space.
    """
    split = Tokenizer.from_file(path).pre_tokenizer
    classes = np.full(0x110000, OTHER, np.uint8)
    points = [c for c in range(0x33500) if not 0xD800 <= c < 0xE000]
    for partner, kind in (("a", LETTER), ("1", DIGIT), ("!", OTHER)):
        # A line for each code point: it shares a piece with a partner of its own kind.
        lines = "".join(f"{chr(c)}{partner}\n" for c in points)
        begins = np.zeros(len(lines) + 1, bool)
        begins[[span[0] for _, span in split.pre_tokenize_str(lines)]] = True
        together = ~begins[1 : 3 * len(points) : 3]
        classes[np.array(points)[together]] = kind
        if partner == "a":
            rest = ~together
        else:
            rest &= ~together
    classes[np.array(points)[rest]] = WHITE
    for letters, kind in (("'", QUOTE), (" ", BLANK), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        classes[[ord(c) for c in letters]] = kind
    classes[ord(END_MARK)] = END
    return classes


def entry_states(kinds: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Entry state of each chunk; ``kinds`` has a row for each step and a column for each chunk."""
    n = kinds.shape[1]
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (n, 1))
    for step, row in enumerate(kinds):
        if step == MEET and (maps == maps[:, :1]).all():
            maps = maps[:, :1]
        maps = following[maps.astype(np.intp) * N_CLASSES + row[:, None]]
    maps = np.broadcast_to(maps, (n, N_STATES)).copy()
    shift = 1
    while shift < n:  # maps[i] is that of all chunks up to i in the end
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift].astype(np.intp), axis=1)
        shift *= 2
    return np.append(np.uint8(FRESH), maps[:-1, FRESH])


def piece_begins(kinds: np.ndarray, following: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each character; end marks count as pieces."""
    n = -(-len(kinds) // CHUNK)
    padded = np.full(n * CHUNK, END, np.uint8)
    padded[: len(kinds)] = kinds
    steps = np.ascontiguousarray(padded.reshape(n, CHUNK).T)
    state = entry_states(steps, following)
    emitted = np.empty_like(steps)
    for step, row in enumerate(steps):
        at = state.astype(np.intp) * N_CLASSES + row
        emitted[step] = marks[at]
        state = following[at]
    emitted = emitted.T.ravel()
    begins = (emitted & HERE).astype(bool) | (padded == END)
    begins[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    return begins[: len(kinds)]


class Transitions:
    """The counter's compiled transitions: a hash table from (state, character) to the next state."""

    def __init__(self):
        self.n, self.slots = 1, 0
        self.tokens = np.zeros(1 << 16, np.int32)  # annotation of a state's leaving transition; 0: none yet
        self._resize(1 << 17)

    def _resize(self, slots: int) -> None:
        old = np.flatnonzero(self.keys >= 0) if self.slots else np.empty(0, np.int64)
        keys, states = (self.keys[old], self.states[old]) if self.slots else (old, old)
        self.slots, self.shift = slots, np.uint64(64 - (slots.bit_length() - 1))
        self.keys, self.states = np.full(slots, -1, np.int64), np.zeros(slots, np.int32)
        self._insert(keys, states)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _insert(self, keys: np.ndarray, states: np.ndarray) -> None:
        """Store distinct keys that are not in the table."""
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.states[taken] = keys[free[first]], states[free[first]]
            rest = np.ones(len(keys), bool)
            rest[free[first]] = False
            keys, states, slot = keys[rest], states[rest], (slot[rest] + 1) & (self.slots - 1)

    def follow(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Next states; transitions that are not there yet are compiled."""
        keys = state.astype(np.int64) << 21 | codes
        slot = self._slot(keys)
        held = self.keys[slot]
        following = self.states[slot]
        look = np.flatnonzero(held != keys)
        missing = []
        while len(look):
            empty = self.keys[slot[look]] < 0
            missing.append(look[empty])
            look = look[~empty]
            slot[look] = (slot[look] + 1) & (self.slots - 1)
            hit = self.keys[slot[look]] == keys[look]
            following[look[hit]] = self.states[slot[look[hit]]]
            look = look[~hit]
        absent = np.concatenate(missing) if missing else look
        if len(absent):
            fresh, which = np.unique(keys[absent], return_inverse=True)
            made = np.arange(self.n, self.n + len(fresh), dtype=np.int32)
            following[absent] = made[which]
            self.n += len(fresh)
            while self.n > len(self.tokens):
                self.tokens = np.append(self.tokens, np.zeros_like(self.tokens))
            if 2 * self.n > self.slots:
                self._resize(4 * self.slots)
            self._insert(fresh, made)
        return following


def states_after(codes: np.ndarray, begins: np.ndarray, skipped: np.ndarray, table: Transitions) -> np.ndarray:
    """The counter's state after each character; it stays at the start on skipped ones."""
    n = -(-len(codes) // CHUNK)
    padded = [np.full(n * CHUNK, fill, kind) for fill, kind in ((0, np.uint32), (False, bool), (True, bool))]
    for whole, given in zip(padded, (codes, begins, skipped), strict=True):
        whole[: len(given)] = given
    codes, begins, skipped = (np.ascontiguousarray(x.reshape(n, CHUNK).T) for x in padded)
    after = np.zeros((CHUNK, n), np.int32)
    opened = begins.any(axis=0)
    first = np.where(opened, begins.argmax(axis=0), CHUNK)
    # From the first marks on: the same whatever state a chunk is entered in.
    state = np.full(n, START, np.int32)
    for step in range(CHUNK):
        state[begins[step]] = START
        run = np.flatnonzero((first <= step) & ~skipped[step])
        state[run] = table.follow(state[run], codes[step, run])
        after[step] = state
    # Before the first marks: entered in the state that the chunk before is left in.
    left = opened | skipped[0]
    waiting = np.flatnonzero((first > 0) & ~skipped[0])
    while len(waiting):
        ready = waiting[left[waiting - 1]]
        state = after[-1, ready - 1]
        for step in range(first[ready].max()):
            run = np.flatnonzero((first[ready] > step) & ~skipped[step, ready])
            state[run] = table.follow(state[run], codes[step, ready[run]])
            after[step, ready[run]] = state[run]
        left[ready] = True
        waiting = waiting[~np.isin(waiting, ready)]
    return after.T.ravel()


class Counter:
    """Counts tokens with a worker's table of compiled transitions."""

    def __init__(self, tables: dict):
        self.tables = tables
        special = sorted(tables["special"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.compiled = Transitions()

    def merged(self, text: str, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens that the merges leave of each piece, in rounds over slices of pieces."""
        tokens = np.empty(len(begins), np.int64)
        for a, b in slices((ends - begins).tolist()):
            pieces = [text[x:y].encode() for x, y in zip(begins[a:b].tolist(), ends[a:b].tolist(), strict=True)]
            tokens[a:b] = bpe.encode_words(pieces, {}, self.tables)[1]
        return tokens

    def emitted(self, text: str, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens that the transducer emits at the end of each piece."""
        if self.compiled.n > STATES:
            self.compiled = Transitions()
        long = ends - begins > LONGEST
        marks, edges = np.zeros(len(codes), bool), np.zeros(len(codes) + 1, np.int8)
        marks[begins] = True
        # Skipped are characters of long pieces, and those of no piece (the marks between sections).
        edges[begins[~long]] += 1
        edges[ends[~long]] -= 1
        after = states_after(codes, marks, np.cumsum(edges[:-1], dtype=np.int8) == 0, self.compiled)
        last = after[ends - 1]
        fresh = np.flatnonzero((self.compiled.tokens[last] == 0) & ~long)
        states, where = np.unique(last[fresh], return_index=True)
        fresh = fresh[where]
        self.compiled.tokens[states] = self.merged(text, begins[fresh], ends[fresh])
        tokens = self.compiled.tokens[last].astype(np.int64)
        tokens[long] = self.merged(text, begins[long], ends[long])
        return tokens

    def count(self, texts: list[str | None]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        for a, b in slices([len(t or "") for t in texts]):
            parts, owner = [], []
            for k in range(a, b):
                sections = [texts[k] or ""]
                if any(token in sections[0] for token in self.tables["special"]):
                    sections = self.special.split(sections[0])
                totals[k] += len(sections) - 1
                parts += sections
                owner += [k] * len(sections)
            joined = END_MARK.join(parts)
            if not joined:
                continue
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            kinds = self.tables["classes"][codes]
            begins = np.flatnonzero(piece_begins(kinds, self.tables["following"], self.tables["marks"]))
            ends = np.append(begins[1:], len(kinds))
            real = kinds[begins] != END
            section = (np.cumsum(~real))[real]
            begins, ends = begins[real], ends[real]
            if not len(begins):
                continue
            composed = np.append(0, np.cumsum(self.emitted(joined, codes, begins, ends)))
            until = np.searchsorted(section, np.arange(len(parts)), side="right")
            np.add.at(totals, owner, np.diff(composed[np.append(0, until)]))
        return totals


def count_tokens(df: DataFrame, path: str, text: str = "text", tokens: str = "n_tokens") -> DataFrame:
    """Add ``tokens``, the number of tokens of ``text`` under the byte-level file at ``path``.

    No special tokens are added; their strings inside a text count as one token each. A null or
    empty text has 0. Rows stay as they are, repeated ones too; a column of the new one's name is
    replaced. The broadcast tables have one entry a token, a merge, and a code point.
    """
    tables = vocab.load(path)
    if tables["normal"] or tables["pattern"] != vocab.BYTE_LEVEL_PATTERN:
        raise ValueError(f"{path} does not split text by the byte-level pattern")
    tables["classes"] = character_classes(path)
    tables["following"], tables["marks"] = splitter()
    shared = df.sparkSession.sparkContext.broadcast(tables)

    def start():
        held = shared.value
        if "counter" not in held:
            held["counter"] = Counter(held)
        counter = held["counter"]

        def work(column: pa.Array) -> list[pa.Array]:
            texts = [None if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]
            return [pa.array(counter.count(texts), pa.int64())]

        return work

    return append_columns(df, [text], [T.StructField(tokens, T.LongType(), False)], start)
