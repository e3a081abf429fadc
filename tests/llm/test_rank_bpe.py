"""Ids and decoded texts against the library of the vocabulary file."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fixtures import table
from haulwatch.llm import rank_bpe
from haulwatch.llm.rank_bpe import codec, decoded, encoded, n_tokens, vocabulary

AWKWARD = [
    "", " \t\n", "word", "<|startoftext|>Hello<|endoftext|>World", "<|endoftext", "It's 'S 'T i'll re've",
    "ab" * 500 + " " + "é" * 100, "x" * 30_000, "ΣΑΣ ΟΔΟΣ ς", "İstanbul ıßǅ", "漢字 かな 🙂🙂 é ạ̀",
    "\x85 \xa0\x1c\x1d a\x00b", "12 345 ½ ²", "a‍b", "�"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    own = codec(vocabulary())
    return np.frombuffer(own.encode(text), "<u4").tolist() == ids and \
        own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_awkward_texts(library):
    assert [text for text in AWKWARD if not same(library, text)] == []


def test_every_latin_character(library):
    assert [i for i in range(0x250) if not same(library, f"ab{chr(i)}cd {chr(i)} x{chr(i)}")] == []


def test_random_texts(library):
    rng = random.Random(1)
    pool = "abcdefghijklmnop'''sst  \n\t\x85\x1céèİıſßǅΣσς漢字🙂é 123<|endoftext|>.,-!\x00"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(2_000)]
    assert [text for text in texts if not same(library, text)] == []


def test_long_words_as_short_ones():
    """The heap and the scan delete the same boundaries."""
    own, rng = codec(vocabulary()), random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 60))).encode()
        ids = [own.inner[b] for b in word[:-1]] + [own.last[word[-1]]]
        assert own._scanned(list(ids)) == own._queued(list(ids))


def test_stretches_and_forgetting(library, monkeypatch):
    text = "Some words, and <|endoftext|> more of them: " * 200 + "é漢" * 50
    monkeypatch.setattr(rank_bpe, "STRETCH", 37)
    monkeypatch.setattr(rank_bpe, "REMEMBERED", 20)
    assert same(library, text) and same(library, text + " end")


def test_rows(spark, library):
    docs = table(spark, extra=True).unionByName(table(spark, [None, "twice", "twice"], extra=True).withColumn("doc_id", F.lit(None).cast("long")))
    rows = decoded(encoded(docs, vocabulary()), vocabulary())
    got = rows.select("doc_id", n_tokens(F.col("ids")).alias("n"), "ids", "text")
    want = []
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        want.append((row["doc_id"], len(ids), np.asarray(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_and_null(spark):
    assert encoded(table(spark, []), vocabulary()).count() == 0
    nothing = spark.createDataFrame([(None, None)], "doc_id long, ids binary")
    assert decoded(nothing, vocabulary()).first()["text"] is None


def test_query(spark, small, library):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = rank_bpe.op11_rank_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
