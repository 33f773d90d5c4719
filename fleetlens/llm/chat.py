"""Chat formatting with loss masks aligned by token offsets.

A conversation is rendered to one string: per turn ``<|turn|>role<|text|>text<|end|>``.  The three control
strings are added tokens of the tokenizer, so a token never crosses one.  Texts and roles are escaped
(backslash doubled, ``<|`` written ``<\\|``), so no control string can occur inside them and the escaping can
be undone.  The string is encoded once with offsets; each token's span is intersected with the sorted spans
of the assistant texts, found by binary search, which gives the mask per token and the masked characters.

Rows are dealt by conversation and sorted by turn in Spark; a task streams through them and holds one
conversation at a time.  Conversations longer than ``PIECE_CHARS`` are encoded in runs of whole turns: as
control strings split the text before the merges, the tokens are the same as of one call.

Null texts and roles are empty.  Rows with equal turn are ordered by role, then text; repeated rows are
turns of their own.  A null conv_id is a conversation of its own; a null turn comes first.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import ship

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PIECE_CHARS = 1 << 20
LEARNED = "assistant"
FORMATTED = ("conv_id long, n_turns long, formatted string, token_ids array<int>, token_mask array<byte>, "
             "mask_starts array<long>, mask_ends array<long>")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_tokens long, n_loss_tokens long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    return "\\".join(part.replace("<\\|", "<|") for part in parts)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import AddedToken, Tokenizer

    made = Tokenizer.from_file(path)
    made.add_tokens([AddedToken(mark, normalized=False) for mark in (TURN, TEXT, END)])
    return made


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The string of some turns, and starts and ends of the learned texts in it."""
    parts, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == LEARNED:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def mask_tokens(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mask per token, and the masked character spans: tokens cut to the learned span they reach into.

    Spans are sorted and disjoint.  Tokens that share the bytes of one character have equal offsets; their
    spans are united.
    """
    if not len(starts) or not len(offsets):
        return np.zeros(len(offsets), np.int8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(ends, offsets[:, 0], side="right")  # the first span that ends behind the token's start
    inside = at < len(starts)
    where = np.minimum(at, len(starts) - 1)
    low = np.maximum(offsets[:, 0], starts[where])
    high = np.minimum(offsets[:, 1], ends[where])
    masked = inside & (low < high)
    low, high = low[masked], high[masked]
    if not len(low):
        return masked.astype(np.int8), low, high
    reach = np.maximum.accumulate(high)
    first = np.concatenate(([True], low[1:] > reach[:-1]))
    last = np.concatenate((first[1:], [True]))
    return masked.astype(np.int8), low[first], reach[last]


def format_turns(turns: list[tuple[str, str]], path: str, piece_chars: int = PIECE_CHARS) -> dict:
    """One formatted conversation: string, token ids, mask per token, masked character spans."""
    tokenizer = _tokenizer(path)
    texts, ids, masks, lows, highs = [], [], [], [], []
    at = done = 0
    while done < len(turns):
        stop, size = done, 0
        while stop < len(turns) and (stop == done or size < piece_chars):
            size += len(turns[stop][1])
            stop += 1
        text, starts, ends = render(turns[done:stop])
        encoded = tokenizer.encode(text, add_special_tokens=False)
        mask, low, high = mask_tokens(np.array(encoded.offsets, np.int64).reshape(-1, 2), starts, ends)
        texts.append(text)
        ids.append(np.array(encoded.ids, np.int32))
        masks.append(mask)
        lows.append(low + at)
        highs.append(high + at)
        at, done = at + len(text), stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return {"n_turns": len(turns), "formatted": "".join(texts), "token_ids": join(ids, np.int32),
            "token_mask": join(masks, np.int8), "mask_starts": join(lows, np.int64),
            "mask_ends": join(highs, np.int64)}


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, text = part.removeprefix(TURN).split(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


def digest(done: dict) -> dict:
    """Counts and hashes of a formatted conversation, all taken from the formatted output."""
    formatted = done["formatted"]
    turns = read_back(formatted)
    sha = hashlib.sha256()
    for role, text in turns:
        sha.update(f"{role}\n{text}\n".encode())
    masked = unescape("".join(
        formatted[a:b] for a, b in zip(done["mask_starts"].tolist(), done["mask_ends"].tolist())))
    return {"n_turns": len(turns), "turns_sha256": sha.hexdigest(), "loss_chars": len(masked),
            "loss_sha256": hashlib.sha256(masked.encode()).hexdigest(), "formatted_chars": len(formatted),
            "n_tokens": len(done["token_ids"]), "n_loss_tokens": int(done["token_mask"].sum())}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    key, turns, begun = None, [], False
    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if begun and conv_id != key:
                yield key, turns
                turns = []
            key, begun = conv_id, True
            turns.append((role or "", text or ""))
    if begun:
        yield key, turns


def _sorted(conversations: DataFrame) -> DataFrame:
    return (conversations
            .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def _apply(conversations: DataFrame, schema: str, work) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for conv_id, turns in _conversations(batches):
            rows.append({"conv_id": conv_id, **work(turns)})
            size += sum(len(text) for _, text in turns)
            if size > PIECE_CHARS:
                yield pa.RecordBatch.from_pylist(rows, kinds)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)

    simple = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
              "array<byte>": pa.list_(pa.int8()), "array<long>": pa.list_(pa.int64())}
    kinds = pa.schema([(name, simple[part.split()[1]]) for name, part in zip(names, schema.split(", "))])
    ship(conversations.sparkSession)
    return _sorted(conversations).mapInArrow(run, schema)


def format_chats(conversations: DataFrame, path: str) -> DataFrame:
    """Per conversation its string, token ids, mask per token and masked character spans."""
    return _apply(conversations, FORMATTED, lambda turns: format_turns(turns, path))


def chat_digests(conversations: DataFrame, path: str) -> DataFrame:
    """Per conversation the digests read back from :func:`format_turns`' output, without shipping it."""
    return _apply(conversations, DIGEST, lambda turns: digest(format_turns(turns, path)))
