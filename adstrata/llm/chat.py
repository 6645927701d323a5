"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered turn after turn between control strings. Inside texts, control strings are
escaped, so that the formatted text can be read back. The control strings are special tokens, at which
the tokenizer cuts: turns rendered in blocks therefore encode as the whole conversation does, and a
long one is shared out among tasks and never in memory at once. Each block is encoded once with offsets; a token is
under the loss mask where its span of characters meets that of an assistant's text, found by binary
search in the sorted spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import AddedToken, Tokenizer

from adstrata.llm.frames import column_name

# Control strings of chat templates, all escaped inside texts.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
TURN, TEXT, CLOSE = "<|im_start|>", "<|im_end|>", "</s>"
LEARNED = "assistant"
# A block of a conversation has the turns of one stretch of so many numbers; it is written in parts,
# each closed at this many characters.
BLOCK_TURNS = 64
PART_CHARS = 1 << 20

CONTROL_PATTERN = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))

BLOCK = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("begins", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("loss", T.ArrayType(T.BooleanType())),
    ]
)


def escape(text: str) -> str:
    """Put a backslash after the first character of each control string, and double backslashes.

    Control strings that overlap in a text are all broken up.
    """
    text = text.replace("\\", "\\\\")
    while CONTROL_PATTERN.search(text):
        text = CONTROL_PATTERN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text lies in it."""
    head = f"{TURN}{escape(role)}{TEXT}"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn, read back."""
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part.removeprefix(TURN).partition(TEXT)
        yield unescape(role), unescape(text)


def chat_tokenizer(spec: str) -> Tokenizer:
    """The tokenizer with the control strings as special tokens after its own."""
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.add_special_tokens([AddedToken(c, normalized=False) for c in CONTROL])
    return tokenizer


def loss_mask(begins: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens that meet one of the spans; spans are sorted and apart, empty ones meet nothing."""
    spans = spans[spans[:, 0] < spans[:, 1]]
    if not len(spans):
        return np.zeros(len(begins), bool)
    following = np.searchsorted(spans[:, 1], begins, side="right")  # first span that ends after the token's begin
    inside = following < len(spans)
    return inside & (spans[np.minimum(following, len(spans) - 1), 0] < ends) & (begins < ends)


def format_conversations(
    df: DataFrame, path: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Render, encode and mask conversations: rows of ``BLOCK``, ordered by ``block`` and ``part``.

    Turns are ordered by their number, then role and text, nulls first; repeated turns are all kept.
    Null roles and texts are empty, and rows without a conversation's id form one of their own. Only
    the four columns are read, whatever others are called. ``begins`` and ``ends`` are the offsets of
    tokens in code points of ``formatted``; ``loss`` says which of them an assistant's text holds.
    Joined in their order, the rows of a conversation are the whole of it. An empty table gives no rows.
    """
    with open(path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file
    rows = df.select(
        F.col(column_name(df, conv)).cast("long").alias("conv_id"),
        F.floor(F.coalesce(F.col(column_name(df, turn)).cast("long"), F.lit(-(1 << 62))) / BLOCK_TURNS).cast("long").alias("block"),
        F.col(column_name(df, turn)).cast("long").alias("turn"),
        F.coalesce(column_name(df, role), F.lit("")).alias("role"),
        F.coalesce(column_name(df, text), F.lit("")).alias("text"),
    )
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("block", pa.int64()),
            ("part", pa.int32()),
            ("n_turns", pa.int64()),
            ("formatted", pa.string()),
            ("ids", pa.list_(pa.int32())),
            ("begins", pa.list_(pa.int32())),
            ("ends", pa.list_(pa.int32())),
            ("loss", pa.list_(pa.bool_())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_tokenizer(shared.value)
        key, part, parts, spans, at = None, 0, [], [], 0

        def closed() -> pa.RecordBatch:
            formatted = "".join(parts)
            found = tokenizer.encode(formatted, add_special_tokens=False)
            offsets = np.array(found.offsets, np.int32).reshape(-1, 2)
            loss = loss_mask(offsets[:, 0], offsets[:, 1], np.array(spans, np.int64).reshape(-1, 2))
            values = [[key[0]], [key[1]], [part], [len(parts)], [formatted], [found.ids], [offsets[:, 0]], [offsets[:, 1]], [loss]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for conv_id, block, who, said in zip(*columns, strict=True):
                if parts and (key != (conv_id, block) or at > PART_CHARS):
                    yield closed()
                    part = part + 1 if key == (conv_id, block) else 0
                    parts, spans, at = [], [], 0
                key = conv_id, block
                turned, a, b = render(who, said)
                if who == LEARNED:
                    spans.append((at + a, at + b))
                parts.append(turned)
                at += len(turned)
        if parts:
            yield closed()

    ordered = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    return ordered.mapInArrow(run, BLOCK)


def summarise(blocks: DataFrame) -> DataFrame:
    """One row a conversation, read back from its blocks: sizes and digests of turns and of masked text.

    ``turns_sha256`` digests role, line feed, text and line feed of each turn; ``loss_sha256`` the
    unescaped text under the mask. Blocks stream by in order, so a conversation's size does not
    matter.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long, n_loss_tokens long"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def masked(formatted: str, begins: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
        """Characters that masked tokens hold; those of one character split among tokens once."""
        held = np.zeros(len(formatted) + 1, np.int32)
        np.add.at(held, begins[loss], 1)
        np.add.at(held, ends[loss], -1)
        inside = np.cumsum(held[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        # Texts are apart by control strings, so each stretch is one text and unescapes by itself.
        return "".join(unescape(formatted[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def closed() -> pa.RecordBatch:
            conv_id, said, learned, (n_turns, loss_chars, chars, n_tokens, n_loss) = state
            row = (conv_id, n_turns, said.hexdigest(), loss_chars, learned.hexdigest(), chars, n_tokens, n_loss)
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema=arrow)

        for batch in batches:
            for k in range(batch.num_rows):
                conv_id, formatted = (batch.column(i)[k].as_py() for i in (0, 4))
                begins, ends, loss = (
                    np.asarray(batch.column(i)[k].values.to_numpy(zero_copy_only=False)) for i in (6, 7, 8)
                )
                if state is None or state[0] != conv_id:
                    if state is not None:
                        yield closed()
                    state = (conv_id, hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0, 0])
                for role, text in turns(formatted):
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[3][0] += 1
                learned = masked(formatted, begins, ends, loss.astype(bool))
                state[2].update(learned.encode())
                counts = (len(learned), len(formatted), len(begins), int(loss.sum()))
                state[3][1:] = [a + b for a, b in zip(state[3][1:], counts, strict=True)]
        if state is not None:
            yield closed()

    kinds = {"long": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in schema.split(", ")])
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    return ordered.mapInArrow(run, schema)
