"""SentencePiece-style encoding and decoding: Unigram Viterbi over a double-array trie.

The text gets a leading blank, blanks become the marker U+2581, and the
segmentation with the largest sum of piece scores wins (ties: the longest
last piece).  Characters that no piece covers are written as their UTF-8 bytes'
pieces ``<0x00>``..``<0xFF>`` with a score below every piece.  No piece holds
a marker behind another character, but some are runs of markers, so the text
is cut before each run of blanks: a run and the word behind it are segmented
as one, and those seen before in the task are looked up (a cache of ``cache``
of them).

Pieces and scores come from a public model file (a parameter); nothing is
trained.  The file's scores are used as log scores as they stand: the public
file is a BPE model, so its own library may cut a word otherwise.

Defined cases: a NULL or empty text has no ids; decoding gives the text back
byte for byte, blanks at both ends included; repeated rows are encoded each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_rows, bytes_view, row_schema

MARK = "▁"
UNIT = re.compile(" +[^ ]*")


class DoubleArray:
    """Byte trie: from state s the byte c leads to t = base[s] + c + 1 if check[t] is s.
    Leaves point at free cells behind the last one, so a walk needs no test for an end."""

    def __init__(self, pieces: dict[bytes, int]):
        tree: dict = {}
        for p, i in pieces.items():
            node = tree
            for c in p:
                node = node.setdefault(c, {})
            node[-1] = i
        self.base, self.check, self.value = [-1], [-2], [-1]
        used = bytearray(b"\1")
        todo = [(0, tree)]
        while todo:
            s, node = todo.pop()
            self.value[s] = node.get(-1, -1)
            codes = sorted(c + 1 for c in node if c >= 0)
            if not codes:
                continue
            cell = max(codes[0], len(used) - 512)      # search the last cells only: quick, a few holes stay
            while True:
                cell = used.find(0, cell)
                if cell < 0:
                    cell = max(codes[0], len(used))
                    break
                if not any(used[cell - codes[0] + c] for c in codes if cell - codes[0] + c < len(used)):
                    break
                cell += 1
            b = cell - codes[0]
            grow = b + codes[-1] + 1 - len(used)
            if grow > 0:
                self.base += [-1] * grow
                self.check += [-1] * grow
                self.value += [-1] * grow
                used += bytes(grow)
            self.base[s] = b
            for c in codes:
                self.check[b + c] = s
                used[b + c] = 1
                todo.append((b + c, node[c - 1]))
        free = len(self.check)
        self.base = [free if b < 0 else b for b in self.base]
        self.check += [-1] * 257


class Codec:
    def __init__(self, model_file: str | None = None, cache: int = 500_000):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file or public_tokenizers.path("piece_bpe_32k.model"))
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = [sp.id_to_piece(i).encode() for i in range(n)]
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.plain = [p.replace(MARK.encode(), b" ") for p in self.pieces]      # each piece as text
        for i, b in self.byte_of.items():
            self.plain[i] = bytes([b])
        self.score = [sp.get_score(i) for i in range(n)]
        self.low = min(self.score[i] for i in normal) - 10.0
        self.trie = DoubleArray({self.pieces[i]: i for i in normal})
        self.seen: dict[str, list[int]] = {}
        self.cache = cache

    def word(self, w: bytes) -> list[int]:
        """Viterbi over one run of markers and the word behind it."""
        base, check, value, score, low = self.trie.base, self.trie.check, self.trie.value, self.score, self.low
        n = len(w)
        best, start, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)      # piece -1: bytes
        best[0] = 0.0
        for k in range(n):
            so_far = best[k]
            if so_far is None:
                continue
            s = 0
            for e in range(k, n):
                t = base[s] + w[e] + 1
                if check[t] != s:
                    break
                s = t
                i = value[s]
                if i >= 0:
                    x = so_far + score[i]
                    if best[e + 1] is None or x > best[e + 1]:
                        best[e + 1], start[e + 1], piece[e + 1] = x, k, i
            size = 1 if w[k] < 0x80 else 2 if w[k] < 0xE0 else 3 if w[k] < 0xF0 else 4
            end = min(k + size, n)
            x = so_far + low * (end - k)
            if best[end] is None or x > best[end]:
                best[end], start[end], piece[end] = x, k, -1
        out, k = [], n
        while k:
            if piece[k] >= 0:
                out.append(piece[k])
            else:
                out += [self.byte_ids[b] for b in reversed(w[start[k]:k])]
            k = start[k]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        mark = MARK.encode()
        # a marker character of the text itself goes as bytes, so decoding is exact
        for part in UNIT.findall(" " + text):
            ids = self.seen.get(part)
            if ids is None:
                own = part.split(MARK)
                ids = self.word(own[0].replace(" ", MARK).encode())
                for rest in own[1:]:
                    ids = ids + [self.byte_ids[b] for b in mark] + self.word(rest.encode())
                if len(self.seen) < self.cache:
                    self.seen[part] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.plain[i] for i in ids]).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, *, keep=None, text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """``row`` (kept columns), ``ids`` and whether decoding them gives the text back."""
    src = as_rows(docs, keep, text_col)

    codec = Codec(model_file)            # a few MB, built once and sent with the function

    def run(batches):
        for b in batches:
            data, off = bytes_view(b.column("text"))
            for i in range(0, len(off) - 1, 256):
                raw = [data[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(off[i:i + 256], off[i + 1:i + 257])]
                ids = [codec.encode(t) for t in raw]
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(i, len(raw)), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([codec.decode(x) == t for x, t in zip(ids, raw)], pa.bool_())], ["row", "ids", "round_trip"])

    return src.mapInArrow(run, row_schema(src, ids=T.ArrayType(T.IntegerType()), round_trip=T.BooleanType()))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, keep=["doc_id"]).select("row.doc_id", F.size("ids").cast("long").alias("n_ids"),
                                                F.xxhash64("ids").alias("ids_hash"), "round_trip")
