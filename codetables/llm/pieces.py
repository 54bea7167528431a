"""SentencePiece encoding and decoding with a unigram model: Viterbi over a double-array trie of pieces.

The trie holds the UTF-8 bytes of all pieces in two integer arrays, made once on the driver and broadcast; its size is
bounded by the vocabulary. Spaces become markers, with one in front of the text. No piece has a marker behind another
character, nor letters beside other characters where the vocabulary was so split, so a text's best path is that of its
chunks one after another, and paths of frequent chunks are remembered in a bounded table. A character that no piece begins with falls back to byte pieces.
Decoding turns byte pieces to bytes and markers to spaces and takes off the one in front.

Scores: a unigram model's log probabilities as they are; for a vocabulary with ranks instead of probabilities (merges),
the log of 1/(rank + 1), by Zipf's law. Sums are double precision; of equal paths the one with the longest last piece
wins.

Defined results: a null or empty text has no pieces. A text that holds the marker character itself is encoded as if it
were a space, so it doesn't come back (`lossless` false). Rows are encoded one by one, so ids may repeat or be missing.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import table, to_bytes

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_LETTERS, _OTHERS = "[^\\W\\d_²³¹]+", f"(?:[^\\w{MARK}]|[\\d_²³¹])+"
#: Chunks that no piece crosses, if pieces are markers, then letters alone or other characters alone; else wider ones.
_FINE = re.compile(f"{MARK}*{_LETTERS}|{MARK}*{_OTHERS}|{MARK}+")
_WIDE = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def double_array(words: list[tuple[bytes, int]]) -> tuple[list[int], list[int], list[int]]:
    """base, check and value (-1: none) of the trie of words; child of state s by byte b is base[s] + b + 1."""
    root: dict = {}
    for word, value in words:
        node = root
        for b in word:
            node = node.setdefault(b, {})
        node[-1] = value
    base, check, value = [0], [-1], [root.get(-1, -1)]
    free, scan, todo = 257, 257, [(0, root)]  # behind the widest child, so that any place can be used
    while todo:
        state, node = todo.pop()
        children = sorted(b for b in node if b >= 0)
        if not children:
            continue
        # An only child takes the first free place; the search for several starts where the last long one ended.
        begin = at = max(1, (free if len(children) == 1 else max(scan, free)) - children[0] - 1)
        while True:
            top = at + children[-1] + 1
            if top >= len(check):
                grow = top + 257 - len(check)
                base += [0] * grow
                check += [-1] * grow
                value += [-1] * grow
            if all(check[at + b + 1] < 0 for b in children):
                break
            at += 1
        if at - begin > 64:
            scan = at
        base[state] = at
        for b in children:
            s = at + b + 1
            check[s] = state
            value[s] = node[b].get(-1, -1)
            todo.append((s, node[b]))
        while free < len(check) and check[free] >= 0:
            free += 1
    room = max(base) + 257 - len(check)
    return base, check + [-1] * room, value + [-1] * room


@dataclass
class Model:
    base: list[int]
    check: list[int]
    value: list[int]
    scores: list[float]
    pieces: list[bytes]  # what a piece decodes to, with spaces for markers; of byte pieces the byte
    byte_ids: list[int]
    unknown: float
    fine: bool
    longest: int  # bytes of a piece

    @staticmethod
    def load(path: str, scores: str = "zipf") -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if scores == "model":
            log = [sp.get_score(i) for i in range(n)]
        else:
            rank = {i: k for k, i in enumerate(plain)}
            log = [-math.log(rank[i] + 1) if i in rank else 0.0 for i in range(n)]
        pieces = [names[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in enumerate(byte_ids):
            pieces[i] = bytes([b])
        trie = double_array([(names[i].encode(), i) for i in plain])
        return Model(*trie, log, pieces, byte_ids, min(log[i] for i in plain) - UNKNOWN_PENALTY, all(_FINE.fullmatch(names[i]) for i in plain), max(len(names[i].encode()) for i in plain))


class Encoder(dict):
    """Ids (as bytes of little-endian unsigned 32-bit numbers) of chunks, remembered up to a bound: of the last LIMIT
    chunks and those of the LIMIT before them that come again."""

    LIMIT = 250_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.old: dict[str, bytes] = {}
        self.cut = (_FINE if model.fine else _WIDE).findall
        self.is_byte = np.zeros(len(model.pieces), bool)
        self.is_byte[model.byte_ids] = True

    def __missing__(self, chunk: str) -> bytes:
        value = self.old.get(chunk)
        if value is None:
            ids = self.best(chunk.encode("utf-8", "surrogatepass"))
            value = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) < 64:
            if len(self) >= self.LIMIT:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value

    def best(self, data: bytes) -> list[int]:
        m, n = self.model, len(data)
        base, check, value, scores, longest = m.base, m.check, m.value, m.scores, m.longest
        total, came, by = [-math.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        total[0] = 0.0
        at = 0
        while at < n:
            first = data[at]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            here, state, end, whole = total[at], 0, at, at + width
            single = False
            # The arrays end with room for the widest child of any state, so no place is beyond them.
            for b in data[at : at + longest]:
                nxt = base[state] + b + 1
                if check[nxt] != state:
                    break
                state = nxt
                end += 1
                piece = value[state]
                if piece >= 0:
                    score = here + scores[piece]
                    if score > total[end]:
                        total[end], came[end], by[end] = score, at, piece
                    if end == whole:
                        single = True
            if not single and here + m.unknown > total[whole]:
                total[whole], came[whole], by[whole] = here + m.unknown, at, -1
            at = whole
        ids: list[int] = []
        while n:
            start = came[n]
            if by[n] < 0:
                ids += [m.byte_ids[b] for b in reversed(data[start:n])]
            else:
                ids.append(by[n])
            n = start
        return ids[::-1]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join([self[c] for c in self.cut(MARK + text.replace(" ", MARK))])


def decode(ids: bytes, model: Model) -> bytes:
    """The UTF-8 bytes that ids stand for."""
    out = b"".join(map(model.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return out[1:] if out[:1] == b" " else out


def _encoders(spark: SparkSession, path: str, scores: str):
    held = spark.sparkContext.broadcast(Model.load(path, scores))
    made: dict[str, Encoder] = {}

    def encoder() -> Encoder:
        if "" not in made:
            made[""] = Encoder(held.value)
        return made[""]

    return encoder


def with_ids(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids", scores: str = "zipf") -> DataFrame:
    """docs with the ids of its text."""
    encoder = _encoders(docs.sparkSession, path, scores)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        e = encoder()
        return texts.map(lambda t: [i for (i,) in struct.iter_unpack("<I", e.encode(t))])

    return docs.withColumn(out_col, ids(F.col(text_col)))


def with_text(coded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text", scores: str = "zipf") -> DataFrame:
    """coded with the text of its ids; bytes that are no UTF-8 become replacement characters."""
    encoder = _encoders(coded.sparkSession, path, scores)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        m = encoder().model
        return ids.map(lambda x: None if x is None else decode(struct.pack(f"<{len(x)}I", *x), m).decode("utf-8", "replace"))

    return coded.withColumn(out_col, text(F.col(ids_col)))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, n_fallback (byte pieces), ids_crc32, decoded_sha256, lossless."""
    encoder = _encoders(spark, model_path(), "zipf")
    schema = "doc_id long, n_pieces long, n_fallback long, ids_crc32 long, decoded_sha256 string, lossless boolean"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder()
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for text in batch.column(1):
                text = text.as_py()
                ids = e.encode(text)
                back = decode(ids, e.model)
                n_bytes = int(e.is_byte[np.frombuffer(ids, "<u4")].sum())
                row = (len(ids) // 4, n_bytes, zlib.crc32(ids), hashlib.sha256(back).hexdigest(), back == to_bytes(text))
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols)], names=[x.split()[0] for x in schema.split(", ")])

    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, schema)
