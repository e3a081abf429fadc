"""Packing documents into training sequences by best-fit decreasing."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, hold, in_slices, saved

#: Tokens of a sequence.
CAPACITY = 2048
#: Id that ends each document.
END = 0
#: Words whose ids a Python worker remembers; beyond that it forgets all and begins anew.
REMEMBERED = 200_000
#: Texts whose new words are learned at once.
TOGETHER = 128
# How byte-level vocabularies write bytes (printable ones as they are, the others in order from 256 on),
# and the pattern that parts text before the merges.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
SPACE = chr(288)
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Latin letters and signs end here.
LATIN_END = "\u0250"

PIECES = "doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
_TOKENIZERS: dict[str, "_Words"] = {}


def _cuttable(word: str) -> bool:
    return bool(word) and not word[0].isspace() and not word[-1].isspace() and "<|" not in word


class _Words:
    """Ids of texts, with the ids of words remembered.

    The tokenizer's first step never joins text across a place where a space stands between two characters that are
    not blank: such a space begins a new part. A text whose every space is of this kind is cut there and the ids
    of the words, each with the space before it, are looked up; all other texts are tokenized whole, and so are
    those with the beginning of a special token.

    New words are tokenized by the library of the vocabulary file. Words in Latin letters, of which there are most,
    go through the same merges in tiktoken, which is several times faster: ids of this vocabulary are in the
    order of its merges, and both libraries class these characters alike. The library of the vocabulary file, the larger
    one in memory, is loaded with the first text that needs it."""

    def __init__(self, file: str):
        import tiktoken

        with open(file, encoding="utf-8") as source:
            content = json.load(source)
        words = content["model"]["vocab"]
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        ranks = {bytes(map(_BYTE_OF.__getitem__, word)): i for word, i in words.items() if word not in special}
        self.merges = tiktoken.Encoding("words", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(max([*words.values(), *special.values()]) + 1, bool)
        self.begins[[i for word, i in words.items() if word[0] == SPACE]] = True
        self.file, self.tokenizer = file, None
        self.first: dict[str, bytes | None] = {}  # words at the beginning of a text
        self.later: dict[str, bytes | None] = {}  # None: no place to cut

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_file(self.file)
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(one.ids, "<u4").tobytes() for one in found]

    def _learn(self, words: set[str]) -> None:
        """Ids of words that follow a space. They are tokenized as one text; a word begins where an id does
        that stands for a space and what follows."""
        self.later.update(dict.fromkeys(words))
        plain = [word for word in words if _cuttable(word)]
        latin = [word for word in plain if word.isascii() or max(word) < LATIN_END]
        if latin:
            text = " " + " ".join(latin)
            self._remember(latin, self.merges.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes())
        other = [word for word in plain if max(word) >= LATIN_END]
        if other:
            self._remember(other, *self._encode([" " + " ".join(other)]))

    def _remember(self, words: list[str], ids: bytes) -> None:
        starts = (4 * np.flatnonzero(self.begins[np.frombuffer(ids, "<u4")])).tolist()
        parts = map(ids.__getitem__, map(slice, starts, [*starts[1:], len(ids)]))
        self.later.update(zip(words, parts, strict=True))

    def _first(self, word: str) -> bytes | None:
        if word not in self.first:
            if len(self.first) >= REMEMBERED:
                self.first.clear()
            self.first[word] = self._alone(word) if _cuttable(word) else None
        return self.first[word]

    def _alone(self, word: str) -> bytes:
        if word.isascii() or max(word) < LATIN_END:
            return self.merges.encode_to_numpy(word, disallowed_special=()).astype("<u4").tobytes()
        return self._encode([word])[0]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = [text.split(" ") for text in texts]
        firsts = [own.pop(0) for own in words]
        new = set().union(*words).difference(self.later)
        if len(self.later) + len(new) > REMEMBERED:
            self.later.clear()
            new = set().union(*words)
        self._learn(new)
        out = []
        for text, first, own in zip(texts, firsts, words):
            parts = [self._first(first), *map(self.later.__getitem__, own)]
            out.append(b"".join(parts) if None not in parts else self._encode([text])[0] if text else b"")
        return out


def token_ids(texts: list[str], file: str) -> Iterator[bytes]:
    """The ids of each text, TOGETHER texts at a time."""
    hold("packing", _TOKENIZERS.clear)
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = _Words(file)
    for at in range(0, len(texts), TOGETHER):
        yield from _TOKENIZERS[file].ids(texts[at:at + TOGETHER])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first takes what is left over by the full ones."""
    first = n % capacity or min(n, capacity)
    edges = [0, *range(first, n + 1, capacity)]
    return list(zip(edges, np.diff(edges).tolist()))


def pieces(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces. A null text is empty: its only id is END."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        end = np.asarray([END], "<u4").tobytes()
        rows = []
        for row, ids in enumerate(token_ids(batch.column("body").to_pylist(), file)):
            ids += end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                rows.append((row, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
        found = np.asarray(rows, np.int64).reshape(-1, 5)
        columns = [batch.column("doc_id").take(pa.array(found[:, 0])), *[pa.array(found[:, i]) for i in range(1, 5)]]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select("doc_id", body().alias("body"))
    return in_slices(rows, run, PIECES.format(id_type=docs.schema["doc_id"].dataType.simpleString()))


class Capacities:
    """Open bins by remaining capacity: a segment tree of which a node counts the bins below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, left: int, bins: int) -> None:
        node = left + self.size
        while node:
            self.count[node] += bins
            node //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least `need` that some bin has."""
        node = need + self.size
        if self.count[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.size:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing of `counts` pieces by length, and the number of bins.

    Pieces of one length are alike, and so are bins that were filled alike, so a step puts many pieces into
    many bins: the tightest bin that takes a length keeps being the tightest until no further piece fits, so
    each of its kind takes as many as fit. The steps, and so the time and size of the plan, depend on the
    capacity and not on the number of pieces. Rows of the plan: length, rank of the first piece of that length,
    first bin, pieces per bin, place of the first piece in its bin."""
    tree, kinds, plan, bins = Capacities(capacity), {}, [], 0

    def open_(left: int, first: int, n: int) -> None:
        if left and n:
            kinds.setdefault(left, []).append((first, n))
            tree.add(left, n)

    for length in sorted(counts, reverse=True):
        need, rank = counts[length], 0
        while need:
            left = tree.tightest(length)
            if left is None:
                new = -(-need // (capacity // length))
                open_(capacity, bins, new)
                bins += new
                left = capacity
            first, n = kinds[left].pop()
            tree.add(left, -n)
            each = left // length
            for many, per in ((min(n, need // each), each), (1, need % each)):
                if many and per and n and need >= per:
                    plan.append((length, rank, first, per, capacity - left))
                    open_(left - per * length, first, many)
                    first, n, need, rank = first + many, n - many, need - many * per, rank + many * per
                if need >= each:
                    break
            open_(left, first, n)
    return np.asarray(plan, np.int64).reshape(-1, 5), bins


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds the rank of each piece among those of its length, from 0: ranks inside a hashed part of the
    length, after the sizes of the parts before it, so that a common length is spread."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    sizes = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1).join(sizes, ["length", "part"])
    return rows.withColumn("rank", F.col("before") + F.col("inside")).drop("part", "before", "inside")


def packed(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of docs(doc_id, text) with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The plan is made on the driver from the number of pieces per length, `capacity` numbers at most, and every
    piece finds its place by its length and its rank in it. Rows that repeat a doc_id, also a null one, are
    packed each; equal rows share no place. Other columns are ignored. An empty table gives no rows."""
    rows = saved(pieces(docs, file, capacity), "pieces")
    counts = {row["length"]: row["n"] for row in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = best_fit_plan(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    key = (plan[:, 0] << 44) + plan[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        step = plan[np.searchsorted(key, (length.to_numpy() << 44) + rank.to_numpy(), "right") - 1]
        at = rank.to_numpy() - step[:, 1]
        return pd.DataFrame({
            "sequence_id": step[:, 2] + at // step[:, 3], "offset": step[:, 4] + at % step[:, 3] * length.to_numpy()})

    rows = _ranked(rows).withColumn("at", place("length", "rank"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")


def vocabulary() -> str:
    """The file of the production tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), vocabulary())
