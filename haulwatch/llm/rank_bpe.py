"""Byte-pair encoding with word ends, by a contiguous array of parts and the ranks between them."""

from __future__ import annotations

import heapq
import json
import os
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, hold, in_slices

#: Words of more symbols are merged with a heap: scanning all ranks for each merge would take quadratic time.
SHORT = 64
#: Characters of the words whose ids a Python worker remembers; beyond that it forgets all and begins anew.
REMEMBERED = 3_000_000
#: Characters of text that are encoded at once.
STRETCH = 1_000_000
#: No merge joins the two parts.
NEVER = 1 << 60

# How byte-level vocabularies write bytes (printable ones as they are, the others in order from 256 on),
# and the pattern of words that the vocabulary file names.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Below this character no text changes by NFC, and all libraries class and lower-case characters alike.
LATIN_END = "\u0250"
BLANK = regex.compile(r"[\x20\x09-\x0D]")

_CODECS: dict[str, "Codec"] = {}


class Codec:
    """The vocabulary of a file: merges by pair of ids, symbols by byte, and the words encoded lately."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(file, encoding="utf-8") as source:
            content = json.load(source)
        model = content["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.inner = [vocab[_LETTER[b]] for b in range(256)]
        self.last = [vocab[_LETTER[b] + end] for b in range(256)]
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.cut = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) or r"(?!)")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in (vocab | self.special).items():
            self.tokens[i] = token
        # characters outside Latin script are normalised and parted by the library of the file
        self.rules = Tokenizer.from_file(file)
        self.byte = {letter: b for b, letter in _LETTER.items()}
        self.known: dict[str, bytes] = {}
        self.held = 0

    def parts(self, word: bytes) -> list[int]:
        """Ids of the parts of a word after all merges."""
        ids = [self.inner[b] for b in word[:-1]]
        ids.append(self.last[word[-1]])
        return self._scanned(ids) if len(ids) <= SHORT else self._queued(ids)

    def _scanned(self, ids: list[int]) -> list[int]:
        """The ranks of neighbouring parts lie in one array: its leftmost minimum names the boundary that goes, then
        the ranks on either side of the new part are looked up again."""
        merges = self.merges
        ranks = [merges.get(pair, (NEVER,))[0] for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            at = ranks.index(least)
            ids[at] = merges[ids[at], ids[at + 1]][1]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = merges.get((ids[at - 1], ids[at]), (NEVER,))[0]
            if at < len(ranks):
                ranks[at] = merges.get((ids[at], ids[at + 1]), (NEVER,))[0]
        return ids

    def _queued(self, ids: list[int]) -> list[int]:
        """The same merges for a long word: the boundaries wait in a heap by (rank, place), parts are a linked list."""
        merges, n = self.merges, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[pair][0], at, *pair) for at, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
        heapq.heapify(heap)
        while heap:
            _, at, one, two = heapq.heappop(heap)
            then = after[at]
            if ids[at] != one or then >= n or ids[then] != two:
                continue  # a part of the pair has been merged since
            ids[at], ids[then] = merges[one, two][1], -1
            after[at] = then = after[then]
            if then < n:
                before[then] = at
            for left, right in ((before[at], at), (at, then)):
                if left >= 0 and right < n and (pair := (ids[left], ids[right])) in merges:
                    heapq.heappush(heap, (merges[pair][0], left, *pair))
        return [i for i in ids if i >= 0]

    def _words(self, text: str) -> list[str]:
        if not text or max(text) < LATIN_END:
            return WORDS.findall(text.lower())
        found = self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(text))
        return [bytes(map(self.byte.__getitem__, word)).decode(errors="surrogateescape") for word, _ in found]

    def _plain(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of text without special tokens."""
        words, known = self._words(text), self.known
        new = set(words).difference(known)
        if self.held > REMEMBERED:
            known.clear()
            self.held, new = 0, set(words)
        for word in new:
            parts = self.parts(word.encode(errors="surrogateescape"))
            known[word] = np.asarray(parts, "<u4").tobytes()
            self.held += len(word)
        return b"".join(map(known.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text. Special tokens are found before anything else; a long text is
        cut at blanks, which no word, no special token and no composed character spans."""
        out, at = [], 0
        for hit in [*self.cut.finditer(text), None]:
            end = hit.start() if hit else len(text)
            while at < end:
                stop = end
                if end - at > STRETCH:
                    blank = BLANK.search(text, at + STRETCH, end)
                    stop = blank.start() if blank else end
                out.append(self._plain(text[at:stop]))
                at = stop
            if hit:
                out.append(np.asarray([self.special[hit[0]]], "<u4").tobytes())
                at = hit.end()
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, with a space between two: the vocabulary has no rule that undoes the byte letters and
        word ends."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(file: str) -> Codec:
    hold("rank_bpe", _CODECS.clear)
    if file not in _CODECS:
        _CODECS[file] = Codec(file)
    return _CODECS[file]


def encoded(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, as binary) of each row of docs(doc_id, text), as the library of the
    vocabulary file gives them without special tokens added. A null text is empty and has no ids. Rows that repeat
    are encoded each, a null doc_id is kept, other columns are ignored, an empty table gives no rows. A very long
    text is encoded in stretches; its ids are one value."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(file)
        ids = [own.encode(text) for text in batch.column("body").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_slices(docs.select("doc_id", body().alias("body")), run, f"doc_id {kind}, ids binary")


def decoded(rows: DataFrame, file: str) -> DataFrame:
    """rows(doc_id, ids), ids as `encoded` gives them, with the text that they decode to, special tokens included; null
    for null."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(file)
        texts = [None if ids is None else own.decode(ids) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_slices(rows.select("doc_id", "ids"), run, f"doc_id {kind}, ids binary, text string")


def n_tokens(ids: Column) -> Column:
    return F.shiftright(F.octet_length(ids), 2).cast("long")


def vocabulary() -> str:
    """The file of the production vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    file = vocabulary()
    rows = decoded(encoded(documents(spark, sf_dir), file), file)
    return rows.select(
        "doc_id", n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
