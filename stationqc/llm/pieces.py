"""SentencePiece encoding and decoding through a table of distinct chunks.

In a model whose pieces never hold a white-space marker after another character,
no merge crosses the edge before a marker: a text is the sequence of its marked
words (markers, then other characters), each segmented by itself.  So every
distinct marked word is segmented once:

1. blocks of documents send their distinct words to fragments by hash;
2. a fragment merges the words of all blocks, segments each once with the library
   and answers every block with the ids in the order the words were sent;
3. a block, its texts compressed, meets its answers and joins the ids back by position.

Words travel once per block rather than once per occurrence, so a frequent word is
no hot key.  If an answer does not match the words of its block (the input was not
read the same way twice), those words are segmented in place: results stay right.

Models that do not meet the condition (checked on the vocabulary) are encoded text
by text.  Defined results: null text is empty; an empty text has only the begin and
end ids; repeated rows each get a result; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.llm.blocks import blocks, map_blocks, released
from stationqc.llm.common import shuffle_partitions

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Characters of a block: what one task holds of texts.
BLOCK_CHARS = 4_000_000


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def chunks_are_independent(path: str) -> bool:
    """Markers only lead a piece, spaces become markers and nothing else is normalised."""
    sp = processor(path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_unknown(i)]
    leading = all(MARK not in p.lstrip(MARK) for p in pieces)
    plain = [" a  b ", "ÉＡ́\t\n x"]
    return leading and all(sp.normalize(t) == MARK + t.replace(" ", MARK) for t in plain)


def chunks(text: str) -> list[str]:
    """Marked words of a text, each without its first marker (every marked word has one).

    The library puts a marker before a text that is not empty.
    """
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in CHUNK.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def segment(words: list[str], path: str) -> list[list[int]]:
    """Ids of marked words: the library supplies the first marker itself, except to nothing."""
    sp = processor(path)
    lone = sp.piece_to_id(MARK)
    return [ids if w else [lone] for w, ids in zip(words, sp.encode(words, num_threads=1))]


def _by_fragment(words: set[str], fragments: int) -> list[list[str]]:
    out: list[list[str]] = [[] for _ in range(fragments)]
    for w in words:
        out[zlib.crc32(w.encode("utf-8", "surrogatepass")) % fragments].append(w)
    for part in out:
        part.sort()
    return out


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def _check(words: list[str]) -> int:
    return zlib.crc32("\x00".join(words).encode("utf-8", "surrogatepass"))


def _words_of(texts: list[str]) -> set[str]:
    seen: set[str] = set()
    for t in texts:
        seen.update(chunks(t))
    return seen


def _send_words(fragments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for block, _, texts in blocks(batches, BLOCK_CHARS):
            rows = [(f, block, _pack(pa.table({"w": pa.array(words, pa.large_string())})))
                    for f, words in enumerate(_by_fragment(_words_of(texts), fragments)) if words]
            yield pd.DataFrame(rows, columns=["fragment", "block", "words"])
    return run


def _answer(path: str):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        lists = [_unpack(w)["w"].to_pylist() for w in group["words"]]
        distinct = sorted(set().union(*lists))
        table = dict(zip(distinct, segment(distinct, path)))
        rows = []
        for block, words in zip(group["block"], lists):
            found = [table[w] for w in words]
            ids = pa.table({"n": pa.array([len(f) for f in found], pa.int32())})
            flat = np.fromiter((i for f in found for i in f), np.int32, sum(map(len, found)))
            rows.append((block, group["fragment"].iloc[0], _check(words), _pack(ids),
                         _pack(pa.table({"i": pa.array(flat, pa.int32())}))))
        return pd.DataFrame(rows, columns=["block", "fragment", "check", "n", "ids"])
    return run


def _send_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    for block, ids, texts in blocks(batches, BLOCK_CHARS):
        table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_string())})
        yield pd.DataFrame({"block": [block], "texts": [_pack(table)]})


def _join_back(path: str, fragments: int, finish=None):
    def run(sent: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        sp = processor(path)
        docs: dict = {"doc_id": [], "ids": []}
        got = {f: (c, n, i) for f, c, n, i in zip(answers["fragment"], answers["check"], answers["n"], answers["ids"])}
        for payload in sent["texts"]:
            table = _unpack(payload)
            texts = table["text"].to_pylist()
            place: dict[str, int] = {}
            sizes, flat = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for f, words in enumerate(_by_fragment(_words_of(texts), fragments)):
                if not words:
                    continue
                check, n, ids = got.get(f, (None, None, None))
                if check == _check(words):
                    sizes.append(_unpack(n)["n"].to_numpy())
                    flat.append(_unpack(ids)["i"].to_numpy())
                else:
                    own = segment(words, path)
                    sizes.append(np.array([len(o) for o in own], np.int32))
                    flat.append(np.array([i for o in own for i in o], np.int32))
                place.update(zip(words, range(len(place), len(place) + len(words))))
            size, pool = np.concatenate(sizes), np.concatenate(flat)
            start = np.concatenate(([0], np.cumsum(size)))[:-1]
            for doc, text in zip(table["doc_id"].to_pylist(), texts):
                at = np.array([place[w] for w in chunks(text)], np.int64)
                n = size[at]
                ends = np.cumsum(n)
                total = int(ends[-1]) if len(ends) else 0
                ids = np.empty(total + 2, np.int32)
                ids[0], ids[-1] = sp.bos_id(), sp.eos_id()
                # position j of the text is position j - (where its word began) of the word
                ids[1:-1] = pool[np.arange(total) + np.repeat(start[at] - (ends - n), n)]
                docs["doc_id"].append(doc)
                docs["ids"].append(ids)
        if finish is not None:
            return finish(docs["doc_id"], docs["ids"])
        return pd.DataFrame({"doc_id": pd.array(docs["doc_id"], "Int64"), "ids": pd.Series(docs["ids"], dtype=object)})
    return run


def _encode_whole(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = processor(path)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [[sp.bos_id(), *ids, sp.eos_id()]
                                                                for ids in sp.encode(texts, num_threads=1)]})
    return run


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fragments = max(16, shuffle_partitions(docs.sparkSession))
    words = map_blocks(rows, _send_words(fragments), "fragment int, block long, words binary")
    answers = words.groupBy("fragment").applyInPandas(
        released(_answer(path)), "block long, fragment int, check long, n binary, ids binary")
    texts = map_blocks(rows, _send_texts, "block long, texts binary")
    return (texts.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInPandas(released(_join_back(path, fragments, finish)), schema))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the library's ids of every whole text, with begin and end ids."""
    if not chunks_are_independent(path):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        return rows.mapInPandas(_encode_whole(path), "doc_id long, ids array<int>")
    return _encoded(docs, path, id_col, text_col, None, "doc_id long, ids array<int>")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_frame(path: str):
    """Decode id lists with the library and digest both sides, one list at a time."""
    def run(doc_ids, lists) -> pd.DataFrame:
        sp = processor(path)
        n, sha_ids, sha_text = [], [], []
        for ids in lists:
            ids = np.asarray(ids)
            n.append(len(ids))
            sha_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            sha_text.append(hashlib.sha256(sp.decode(ids.tolist()).encode("utf-8")).hexdigest())
        return pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "n_tokens": pd.Series(n, dtype="int64"),
                             "ids_sha256": sha_ids, "decoded_sha256": sha_text})
    return run


def digest(encoded: DataFrame, path: str) -> DataFrame:
    """Digests of rows of (doc_id, ids) and of what the library decodes from them."""
    frame = _digest_frame(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield frame(pdf["doc_id"], pdf["ids"])
    return encoded.mapInPandas(run, DIGESTS)


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digest(encode(docs))``, digested where a block's ids are joined, so that ids need no further trip."""
    if not chunks_are_independent(path):
        return digest(encode(docs, path, id_col, text_col), path)
    return _encoded(docs, path, id_col, text_col, _digest_frame(path), DIGESTS)
