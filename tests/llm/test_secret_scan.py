import hashlib

import numpy as np
import pytest

from fixtures import table, texts
from haulwatch.llm import secret_scan as S


@pytest.fixture(scope="module")
def ratio(spark):
    return S.trained_ratio(table(spark))


def test_base_spans():
    text = 'Token = "abcdefghijkl" é secret: short AKIA1234567890ABCD AKIA12 0123456789abcdef 0123456789abcde'
    assert S.base_spans(text) == [(0, 21, "assign"), (39, 57, "access"), (65, 81, "hex")]
    # a match that fails still uses up its text
    assert S.base_spans("secret: token: abcdefghijklmnop") == []
    assert S.base_spans("api-key=abcdefghijkl") == [] and len(S.base_spans("API_KEY'  :  'abcdefghijkl")) == 1
    assert S.base_spans("toKen=abcdefghijkl") == []  # a Kelvin sign is no k
    assert S.base_spans("password=0123456789abcdef0") == [(0, 26, "assign"), (9, 26, "hex")]


def test_models_tell_random_from_ordinary(ratio):
    rng = np.random.default_rng(99)
    random = ["".join(rng.choice(list(S.ALPHABETS[i % len(S.ALPHABETS)]), 24)) for i in range(300)]
    plain = ["harbor_winter_signal", "copperMeadowLantern", "orchard/canyon/velvet-marble", "-" * 30, "2024-01-15-12-30-44",
             "gravelgravelgravel", "8894160621567258123", "with_the_signal_of_winter"]
    assert (S.scores(random, ratio) >= S.THRESHOLD).mean() >= 0.98
    assert (S.scores(plain, ratio) < S.THRESHOLD).all()


def test_added_spans(spark, ratio):
    text = "the key Xk29fJq81LmZpQ7vTn4w is é9233A8ECF7C5B09FE5949719B6B82BC439E9329B and harbor_winter_signal_copper"
    rows = [text, None, "", 'secret="Xk29fJq81LmZpQ7vTn4w"', "ab " * 50_000 + "Xk29fJq81LmZpQ7vTn4w"]
    out = {r["doc_id"]: r for r in S.secrets(table(spark, rows, extra=True), ratio).collect()}
    assert out[0]["spans"] == "markov:8:28,markov:33:73" and out[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert out[1]["spans"] == out[2]["spans"] == "" and out[3]["spans"] == "assign:0:28"
    assert out[3]["base_sha256"] == hashlib.sha256(b"assign:0:28").hexdigest()
    assert out[4]["spans"] == "markov:150000:150020"


def plain_spans(text, ratio):
    """Candidate by candidate and character by character."""
    base = S.base_spans(text)
    inside = {i for a, z, _ in base for i in range(a, z)}
    out = []

    def score(string):
        places = [S.SYMBOLS.index(c) for c in string]
        return sum(ratio[last, here] for last, here in zip([len(S.SYMBOLS), *places], places))

    for m in S.CANDIDATE.finditer(text):
        free = [i for i in range(m.start(), m.end()) if i not in inside]
        if not free or score(m.group()) < S.THRESHOLD:
            continue
        runs = [(i, next(j for j in range(i, m.end() + 1) if j == m.end() or j in inside)) for i in free if i - 1 not in free]
        out += [(a, z, "markov") for a, z in runs if (a, z) == m.span() or score(text[a:z]) > 0]
    return out


def test_spans_by_brute_force(ratio):
    """Random strings alone, around hex characters, next to keys, in names; words between them."""
    rng = np.random.default_rng(5)
    pick = lambda n, letters=S.ALPHABETS[3]: "".join(rng.choice(list(letters), n))
    for _ in range(300):
        text = " ".join(rng.choice([
            pick(24), pick(10) + pick(20, S.ALPHABETS[0]) + pick(9), "AKIA" + pick(20, S.ALPHABETS[2]) + "/" + pick(12),
            f"token={pick(14)} {pick(18)}", "harbor_" + pick(18, S.ALPHABETS[0]) + "_final", "copper_meadow_lantern_x",
            "é" + pick(17), "plain words", f"secret:{pick(5)}", pick(12) + "." + pick(30)]) for _ in range(6))
        found = S.markov_spans(text, S.base_spans(text), ratio)
        assert found == plain_spans(text, ratio), text
        assert not any(a < end and start < z for a, z, _ in found for start, end, _ in S.base_spans(text))


def test_random_around_hex(ratio):
    text = "key Xk29fJq8LmZpQvT0123456789abcdefQ7vTn4wRb8Kc2W end"
    base = S.base_spans(text)
    assert [text[a:z] for a, z, _ in base] == ["0123456789abcdef"]
    assert [text[a:z] for a, z, _ in S.markov_spans(text, base, ratio)] == ["Xk29fJq8LmZpQvT", "Q7vTn4wRb8Kc2W"]


def test_planted_strings(spark):
    """Recall on planted random strings and precision on the documents they are planted in."""
    rng = np.random.default_rng(12)
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    ratio = S.trained_ratio(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    planted = caught = extra = 0
    for i, text in enumerate(docs):
        key = "".join(rng.choice(list(S.ALPHABETS[i % len(S.ALPHABETS)]), int(rng.integers(20, 40))))
        spans = S.markov_spans(f"{text} {key}", S.base_spans(f"{text} {key}"), ratio)
        if not S.base_spans(key):
            planted += 1
            caught += (len(text) + 1, len(text) + 1 + len(key), "markov") in spans
        extra += sum(a <= len(text) for a, _, _ in spans)
    assert planted > 600 and caught >= 0.97 * planted and extra <= 0.002 * len(docs)


def test_every_document_is_counted(spark):
    """Transitions of all texts, in portions and tasks, add up."""
    rows = [t for t in texts() if t]
    want = np.zeros((2, len(S.SYMBOLS) + 1, len(S.SYMBOLS)))
    for text in rows:
        spans = S.base_spans(text)
        for table_, strings in zip(want, (S._random(text, spans), S._identifiers(text, spans))):
            for string in strings:
                places = [S.SYMBOLS.index(c) for c in string]
                for last, here in zip([len(S.SYMBOLS), *places], places):
                    table_[last, here] += 1
    assert (S.text_transitions(rows) == want).all()


def test_clean_texts_and_empty(spark, ratio):
    out = S.secrets(table(spark), ratio).collect()
    assert len(out) == len(texts()) and {r["spans"] for r in out} == {""}
    assert S.secrets(table(spark, [])).count() == 0
