"""Small tables with the awkward rows that every operator has to take: nulls, empty and very long texts, ties, repeated rows."""

import numpy as np

WORDS = ("the of and to in is that for on with as by at from this be are or an it "
         "harbor winter signal copper meadow lantern gravel timber orchard canyon velvet marble").split()


def prose(rng, lines, words=12):
    return "\n".join(" ".join(rng.choice(WORDS, rng.integers(1, words + 1))).capitalize() + "." for _ in range(lines))


def texts(seed=0, n=40):
    rng = np.random.default_rng(seed)
    out = [prose(rng, int(rng.integers(1, 12))) for _ in range(n)]
    out += [out[3], out[3], out[5] + "\n" + out[6], out[7].replace("the", "a", 1), None, "", " \t\n", "word", "word",
            "\n\n" + out[8] + "\n\n\n" + out[9], out[10].replace(" ", "  "), "é ü 漢字   ñ\x0b end\x0c",
            prose(rng, 900), "x" * 30_000, "Der " * 3_000]
    return out


def table(spark, rows=None, extra=False):
    """doc_id, text, lang, source, n_chars; with columns that clash with the names of results, if asked for."""
    rows = texts() if rows is None else rows
    langs, sources = ("en", "de", None), ("a", "b", "c", None)
    data = [(i, text, langs[i % 3], sources[i % 4], None if text is None else len(text)) for i, text in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        names = ("kept", "score", "n", "key", "body", "h", "rank", "length", "size", "target", "runs", "n_lines",
                 "text_hash", "node", "component_id", "label", "stratum", "n_words", "digest", "unit", "copies")
        data = [(*row, *["x"] * len(names)) for row in data]
        schema += "".join(f", {name} string" for name in names)
    return spark.createDataFrame(data, schema)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
