"""Chat formatting by token-level assembly.

Every turn is encoded in separate segments (header, text); the marks of the
template are reserved ids spliced between them, so no text can spell a mark: in
the ids a mark is unmistakable.  Control strings occurring in content are escaped
reversibly as well, so the rendered text is unambiguous too: ``<|`` becomes
``<\\|`` and a backslash run between ``<`` and ``|`` grows by one.  A line feed in a role
becomes ``<\\n>``, and a backslash run between ``<`` and ``n>`` there grows by one.  The
loss mask of a conversation follows from the segment lengths by prefix sums.

Turns are encoded row by row, before grouping; a conversation (one output row) is
assembled from its turns' ids.

Defined results: null text is empty, null role is an empty role; turns that tie are
ordered by role and text; turn null sorts first; repeated rows are turns of their
own; a null conv_id is one conversation; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's reserved ids lie above the vocabulary.
MARKS = {"<|im_start|>": 0, "<|im_end|>": 1}
BATCH_CHARS = 1 << 20


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line: escaped, line feeds written as a mark of their own."""
    return escape(re.sub(r"<(\\+)n>", r"<\\\1n>", role).replace("\n", "<\\n>"))


def unescape_role(line: str) -> str:
    return re.sub(r"<\\(\\*)n>", lambda m: f"<{m[1]}n>" if m[1] else "\n", unescape(line))


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    tok.no_truncation()
    return tok


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in printable}
    for k, b in enumerate(b for b in range(256) if b not in set(printable)):
        table[chr(256 + k)] = b
    tok = tokenizer(path)
    out = [b""] * tok.get_vocab_size()
    for piece, i in tok.get_vocab().items():
        out[i] = bytes(table[c] for c in piece) if all(c in table for c in piece) else piece.encode()
    return out


def encode_segments(texts: list[str], path: str) -> list[list[int]]:
    tok, out, batch, size = tokenizer(path), [], [], 0
    for t in texts:
        batch.append(t)
        size += len(t)
        if size > BATCH_CHARS:
            out += [e.ids for e in tok.encode_batch_fast(batch, add_special_tokens=False)]
            batch, size = [], 0
    return out + [e.ids for e in tok.encode_batch_fast(batch, add_special_tokens=False)]


def encode_turns(rows: DataFrame, path: str) -> DataFrame:
    """Add head and body (ids of the escaped role line and of the escaped text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["head"] = encode_segments([escape_role(r) + "\n" for r in pdf["role"]], path)
            pdf["body"] = encode_segments([escape(t) for t in pdf["text"]], path)
            yield pdf

    return rows.mapInPandas(run, "conv_id long, turn long, role string, text string, head array<int>, body array<int>")


def assemble(heads: list, bodies: list, loss: list[bool], base: int, newline: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one conversation: marks spliced in, mask from prefix sums of the segment lengths."""
    start, end = base + MARKS["<|im_start|>"], base + MARKS["<|im_end|>"]
    segments, counted = [], []
    for head, body, own in zip(heads, bodies, loss):
        segments += [[start], head, body, [end], newline]
        counted += [False, False, own, False, False]
    ids = np.concatenate([np.asarray(s, np.int32) for s in segments]) if segments else np.zeros(0, np.int32)
    ends = np.cumsum([len(s) for s in segments])
    edge = np.zeros(len(ids) + 1, np.int32)
    for stop, size, own in zip(ends, map(len, segments), counted):
        if own:
            edge[stop - size] += 1
            edge[stop] -= 1
    return ids, np.cumsum(edge)[:-1].astype(bool)


def format_chats(turns: DataFrame, path: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, ids array<int>, mask array<boolean> of every conversation."""
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    coded = encode_turns(rows, path)
    turn = F.struct("turn", "role", "text", "head", "body")
    convs = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.head").alias("heads"),
                         F.col("turns.body").alias("bodies"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, newline = len(token_bytes(path)), encode_segments(["\n"], path)[0]
        for pdf in batches:
            done = [assemble(h, b, [x in loss_roles for x in r], base, newline)
                    for r, h, b in zip(pdf["roles"], pdf["heads"], pdf["bodies"])]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "ids": [x for x, _ in done], "mask": [x for _, x in done]})

    return convs.mapInPandas(run, "conv_id long, ids array<int>, mask array<boolean>")


def read_back(ids: np.ndarray, mask: np.ndarray, table: list[bytes]) -> tuple[list[tuple[str, str]], str, str]:
    """Turns, text under the mask, and rendered text, from ids and mask alone."""
    base = len(table)
    names = {base + k: m for m, k in MARKS.items()}
    text = lambda part: b"".join(table[i] for i in part).decode("utf-8")
    turns, loss, shown = [], [], []
    starts = np.flatnonzero(ids == base + MARKS["<|im_start|>"])
    stops = np.flatnonzero(ids == base + MARKS["<|im_end|>"])
    tail = 0
    for a, z in zip(starts, stops):
        inner = text(ids[a + 1:z])
        shown += [text(ids[tail:a]), names[ids[a]], inner, names[ids[z]]]
        tail = z + 1
        role, _, body = inner.partition("\n")
        turns.append((unescape_role(role), unescape(body)))
        loss.append(unescape(text(ids[a:z][mask[a:z]])))
    return turns, "".join(loss), "".join(shown) + text(ids[tail:])


def digest_chats(chats: DataFrame, path: str) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = token_bytes(path)
        for pdf in batches:
            rows = []
            for conv, ids, mask in zip(pdf["conv_id"], pdf["ids"], pdf["mask"]):
                turns, loss, shown = read_back(np.asarray(ids), np.asarray(mask, bool), table)
                rows.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                             len(shown)))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                              "formatted_chars"])

    return chats.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long")
