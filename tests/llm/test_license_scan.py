from fixtures import rows_of, table, texts
from haulwatch.llm import license_scan as L


def test_whole_paragraph_and_line(spark):
    mit = L.MIT.replace("\n", "\r\n  ").upper()
    rows = ["Copyright (c) 2020 A. Person\n\n" + L.MIT, "Some words.\n\n" + L.BSD_WARRANTY + "\n\nmore",
            "x\nLicensed under the Apache Licence, version 2.0\ny\nReleased under the MIT License.", mit,
            "not Released under the MIT License at all", None, "", "(c) 2020 B. Person\nAll rights reserved."]
    found = {r["doc_id"]: tuple(r)[1:] for r in L.license_report(table(spark, rows, extra=True), L.known_licenses(spark)).collect()}
    assert found[0][1:] == ("MIT", True) and found[3][1:] == ("MIT", True)
    assert found[2] == (2, "Apache-2.0,MIT", False)
    assert {found[i] for i in (1, 4, 5, 6, 7)} == {(0, "", False)}


def test_own_list(spark):
    docs = spark.createDataFrame([(1, "Be  kind!\n\nrest"), (1, "be kind"), (None, "Be kind."), (2, "kind be")], "doc_id long, text string")
    known = spark.createDataFrame([("K", "be, kind"), ("K", "Be kind"), (None, "rest"), ("N", None)], "license_id string, text string")
    assert rows_of(L.licenses(docs, known)) == sorted(
        [(1, "K", "line", 2), (1, "K", "paragraph", 2), (1, "K", "text", 1), (None, "K", "line", 1),
         (None, "K", "paragraph", 1), (None, "K", "text", 1)], key=repr)


def test_other_texts_and_empty(spark):
    known = L.known_licenses(spark)
    assert L.license_report(table(spark), known).count() == len(texts())
    assert L.license_report(table(spark, []), known).count() == 0


def test_embedded_licences(spark):
    bsd2, isc = dict(L.TEXTS)["BSD-2-Clause"], L.ISC_GRANT + L.ISC_CONDITION + "\n\n" + L.ISC_WARRANTY
    rows = ["My tool\n\n" + L.MIT + "\n\nint main;", "code\n\nMIT License\n\n(c) 2020 A. Person\n\n" + L.MIT,
            isc + "\n\nand\n\n" + bsd2, L.MIT, "x\n\n" + L.MIT.rsplit("\n\n", 1)[0] + "\n\ny", L.MIT + "\n\n" + L.MIT, "MIT License\n\n" + L.MIT]
    rows.append(rows[0])
    docs = spark.createDataFrame([(i % 7, t) for i, t in enumerate(rows)], "doc_id long, text string")
    assert rows_of(L.licenses(docs, L.known_licenses(spark))) == sorted([
        (0, "MIT", "run", 2), (1, "MIT", "run", 1), (2, "BSD-2-Clause", "run", 1), (2, "ISC", "run", 1),
        (3, "MIT", "text", 1), (5, "MIT", "run", 2), (6, "MIT", "text", 1)], key=repr)
    found = {tuple(r) for r in L.license_report(docs, L.known_licenses(spark)).collect()}
    assert (0, 2, "MIT", False) in found and (4, 0, "", False) in found


def test_sql_of_embedded_licences(spark):
    """The SQL of the query finds runs of paragraphs too, and of runs inside each other the longest."""
    import duckdb

    rows = ["My tool\n\n" + L.MIT + "\n\nint main;", L.MIT, L.MIT + "\n\n" + L.MIT, "MIT License\n\n" + L.MIT + "\n\nx",
            dict(L.TEXTS)["BSD-3-Clause"] + "\n\nand\n\n" + dict(L.TEXTS)["BSD-2-Clause"], "Released under the MIT License",
            "a\n\nReleased under the MIT License.\n\nb", None, "", "plain"]
    docs = table(spark, [*rows, rows[0]])
    con = duckdb.connect()
    con.register("docs", docs.select("doc_id", "text").toPandas())
    con.sql("create view documents as select doc_id, text from docs")
    got = sorted(tuple(r) for r in L.license_report(docs, L.known_licenses(spark)).collect())
    rel = con.sql(L.ORACLE)
    assert rel.columns == ["doc_id", "n_matches", "license_ids", "is_license"] and sorted(rel.fetchall()) == got
    assert sum(n > 0 for _, n, _, _ in got) == 8


def test_known_from_table(spark, tmp_path):
    text = "Own licence\n\nBe kind.\n\nStay kind."
    spark.createDataFrame([("Own", text)], "license_id string, text string").write.parquet(f"{tmp_path}/known")
    docs = table(spark, ["a\n\n" + text + "\n\nb", text, "Released under the MIT License"])
    found = L.licenses(docs, L.known_licenses(spark, f"{tmp_path}/known"))
    assert rows_of(found) == [(0, "Own", "run", 1), (1, "Own", "text", 1)] + [
        (2, "MIT", unit, 1) for unit in ("line", "paragraph", "text")]
