"""A Merkle manifest of a data set: a tree of digests per language, and one over the languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulwatch.llm.common import documents, saved

#: Children of a node, as a power of two.
BITS = 3
#: Levels that a block nests: a block has 8 x 8 x 8 leaves.
DIGITS = 3
#: Columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NO_STEPS = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: of each value its length in UTF-8 bytes, a colon and the value; a hyphen for null."""
    texts = [field.cast("string") for field in fields]
    return digest(*[
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts])


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds `rank`, the place of a row among those of its key in the given order, from 0, and `n`, how many they are.

    Rows are dealt to ranges of (key, order); a range counts its rows per key, and a row's rank is its place in its
    range after the counts of the ranges before it. So a key with most of the rows is spread like any other, and so
    are rows that repeat all values, which change places freely. Rows are stored first: dealing to ranges reads them
    twice, and what they were made from may be long."""
    rows = saved(rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    dealt = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in (key, *order, "_at")])
    dealt = saved(dealt.withColumn("_range", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    of_key = W.partitionBy(key)
    before = F.sum("_n").over(of_key.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(
        F.col(key).alias("_key"), F.col("_range").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_n").over(of_key).alias("n"))
    own = W.partitionBy(key, "_range").orderBy(*[F.col(c).asc_nulls_first() for c in (*order, "_at")])
    rows = dealt.withColumn("_own", F.row_number().over(own) - 1)
    rows = rows.join(counts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of")))
    return rows.withColumn("rank", F.col("_before") + F.col("_own")).drop(
        "_at", "_range", "_own", "_key", "_of", "_before")


def _many(level: int) -> Column:
    """Whether a key has several nodes at this level; then runs of them are hashed, else the one node is passed on."""
    return F.col("n") > 1 << BITS * level


def _rolled(nodes: DataFrame) -> DataFrame:
    """key, n, block, node of nodes(key, n, rank, hash, carried): each block as one nested struct.

    The digits of a rank are grouped away one after the other: leaves into runs, runs into runs of runs, these into
    blocks. A node holds its digit, its hash, its children and their hashes in a row. A block goes to one task, with
    8 x 8 x 8 leaves at most; the groupings inside it need no further shuffle."""
    digits = [F.shiftright("rank", BITS * i).bitwiseAND((1 << BITS) - 1).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    block = F.shiftright("rank", BITS * DIGITS).alias("block")
    x = nodes.select("key", "n", block, *digits, "hash", "carried").repartition("key", "n", "block")
    x = x.select("key", "n", "block", *[f"d{i}" for i in range(1, DIGITS)],
                 F.struct(F.col("d0").alias("digit"), "hash", "carried").alias("node"))
    for level in range(DIGITS):
        left = [f"d{i}" for i in range(level + 1, DIGITS)]
        x = x.groupBy("key", "n", "block", *left).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        x = x.withColumn("hashes", F.array_join(F.transform("kids", lambda kid: kid["hash"]), ""))
        own = F.when(_many(level), digest(F.col("hashes"))).otherwise(F.col("kids")[0]["hash"])
        digit = F.col(left[0]) if left else F.lit(0)
        x = x.select("key", "n", "block", *left[1:],
                     F.struct(digit.alias("digit"), own.alias("hash"), "hashes", "kids").alias("node"))
    return x


def _step(node: Column, at: Column, level: int) -> Column:
    """The siblings of a node's child as an array of one step; of none where the level has a single node."""
    width = 64
    left = F.substring(node["hashes"], F.lit(1), at * width)
    right = F.substring(node["hashes"], (at + 1) * width + 1, F.length(node["hashes"]))
    return F.when(_many(level), F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(
        F.array().cast(NO_STEPS))


def _leaves(node: Column, level: int, above: Column) -> Column:
    """carried, hash, path of every leaf under a node."""
    def child(kid: Column, at: Column) -> Column:
        path = F.concat(_step(node, at, level), above)
        if level:
            return _leaves(kid, level - 1, path)
        return F.struct(kid["carried"].alias("carried"), kid["hash"].alias("hash"), path.alias("path"))

    below = F.transform(node["kids"], child)
    return F.flatten(below) if level else below


def proofs(nodes: DataFrame) -> DataFrame:
    """key, carried, hash, path, root of nodes(key, n, rank, hash, carried): the steps from a node to the root of its
    key, lowest first, each with the hashes left and right of the way.

    Blocks are rolled up by themselves; their roots, one for 512 nodes, are the nodes of the tree above, and its paths
    come back to the blocks before these are exploded. Nothing is joined to a leaf."""
    blocks = saved(_rolled(nodes), "blocks")
    most = blocks.agg(F.max("n")).first()[0] or 0
    if most > 1 << BITS * DIGITS:
        above = proofs(blocks.select(
            "key", F.ceil(F.col("n") / (1 << BITS * DIGITS)).cast("long").alias("n"), F.col("block").alias("rank"),
            F.col("node.hash").alias("hash"), F.col("block").alias("carried")))
        above = above.select(
            F.col("key").alias("_key"), F.col("carried").alias("_block"), F.col("path").alias("above"), "root")
        blocks = blocks.join(above, F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")))
    else:
        blocks = blocks.withColumn("above", F.array().cast(NO_STEPS)).withColumn("root", F.col("node.hash"))
    leaves = blocks.select("key", "root", F.explode(_leaves(F.col("node"), DIGITS - 1, F.col("above"))).alias("leaf"))
    return leaves.select("key", "leaf.carried", "leaf.hash", "leaf.path", "root")


def folded(leaf_hash: Column, path: Column) -> Column:
    """The root that follows from a leaf and the hashes beside its way."""
    return F.aggregate(path, leaf_hash, lambda own, step: digest(step["left"], own, step["right"]))


def manifest(rows: DataFrame, key: str, order: list[str], carried: list[str]) -> DataFrame:
    """Trees over rows(key, leaf, order, carried): key, the carried columns, leaf, subroot, root, path.

    Rows of a key, ordered by `order` (nulls first), are the leaves of its tree; while there are several nodes, every
    eight in a row become one. The roots of the keys, in the order of the keys (null first), make up the tree whose
    root is `root`; path leads from a leaf by way of the subroot to it. Rows that repeat the order are placed by their
    leaf; a key of one row has no steps of its own; an empty table gives no rows."""
    rows = rows.select(F.col(key).alias("key"), "leaf", *[
        F.col(c).alias(f"_{c}") for c in dict.fromkeys((*order, *carried))])
    rows = ranked(rows, "key", [*[f"_{c}" for c in order], "leaf"])
    inner = saved(proofs(rows.select("key", "n", "rank", F.col("leaf").alias("hash"), F.struct(*[
        F.col(f"_{c}").alias(c) for c in carried]).alias("carried"))), "paths")
    roots = saved(inner.groupBy("key").agg(F.first("root").alias("subroot")), "subroots")
    top = ranked(roots.withColumn("all", F.lit(0)), "all", ["key"]).select(
        F.col("all").alias("key"), "n", "rank", F.col("subroot").alias("hash"), F.col("key").alias("carried"))
    top = proofs(top).select(F.col("carried").alias("_key"), F.col("path").alias("upper"), F.col("root").alias("_root"))
    out = inner.join(top, F.col("key").eqNullSafe(F.col("_key")))
    return out.select(
        F.col("key").alias(key), "carried.*", F.col("hash").alias("leaf"), F.col("root").alias("subroot"),
        F.col("_root").alias("root"), F.concat("path", "upper").alias("path"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and roots, and whether its row, altered for a third of the ids, still proves it."""
    docs = documents(spark, sf_dir)
    altered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(
        "doc_id", "lang", leaf([F.col(c) for c in FIELDS]).alias("leaf"),
        F.when(altered, leaf([F.col(c) for c in FIELDS[:-1]] + [lower])).alias("claimed"))
    out = manifest(rows, "lang", ["doc_id"], ["doc_id", "claimed"])
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    out = out.withColumn("folded_root", folded(F.coalesce("claimed", "leaf"), F.col("path")))
    return out.select(
        "doc_id", "lang", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLE = """
WITH RECURSIVE
bits AS (
  SELECT list(c ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM range(256) t(i))),
rows_ AS (
  SELECT doc_id, lang, source, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
        lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1])), 4294967295) % 3 = 0 AS hit
  FROM documents, bits),
leaves AS (
  SELECT doc_id, lang, hit,
    sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
      || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
      || coalesce(strlen(low) || ':' || low, '-')) AS changed
  FROM rows_),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
tree AS (
  SELECT lang, 0 AS lvl, rank AS idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
  FROM tree WHERE n > 1 GROUP BY lang, lvl, idx // 8, n),
subs AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n
  FROM tree WHERE n = 1),
upper_ AS (
  SELECT 0 AS lvl, rank AS idx, subroot AS h, n FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
  FROM upper_ WHERE n > 1 GROUP BY lvl, idx // 8, n),
runs AS (SELECT lang, lvl, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM tree WHERE n > 1 GROUP BY lang, lvl, idx // 8),
upruns AS (SELECT lvl, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM upper_ WHERE n > 1 GROUP BY lvl, idx // 8),
steps AS (
  SELECT p.lang, p.rank, r.lvl, array_to_string(r.hs[1:pos], '') || '|' || array_to_string(r.hs[pos + 2:], '') AS step
  FROM (SELECT lang, rank, lvl, rank // (8 ** (lvl + 1))::BIGINT AS run, (rank // (8 ** lvl)::BIGINT) % 8 AS pos
        FROM placed, range(21) t(lvl) WHERE n > 8 ** lvl) p
  JOIN runs r ON r.lang IS NOT DISTINCT FROM p.lang AND r.lvl = p.lvl AND r.run = p.run),
upsteps AS (
  SELECT p.lang, r.lvl, array_to_string(r.hs[1:pos], '') || '|' || array_to_string(r.hs[pos + 2:], '') AS step
  FROM (SELECT lang, lvl, rank // (8 ** (lvl + 1))::BIGINT AS run, (rank // (8 ** lvl)::BIGINT) % 8 AS pos
        FROM subs, range(21) t(lvl) WHERE n > 8 ** lvl) p
  JOIN upruns r ON r.lvl = p.lvl AND r.run = p.run),
paths AS (SELECT lang, rank, list(step ORDER BY lvl) AS path FROM steps GROUP BY lang, rank),
uppaths AS (SELECT lang, list(step ORDER BY lvl) AS path FROM upsteps GROUP BY lang),
whole AS (
  SELECT p.*, s.subroot, (SELECT h FROM upper_ WHERE upper_.n = 1) AS root,
         coalesce(a.path, []) || coalesce(b.path, []) AS path
  FROM placed p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN paths a ON a.lang IS NOT DISTINCT FROM p.lang AND a.rank = p.rank
  LEFT JOIN uppaths b ON b.lang IS NOT DISTINCT FROM p.lang),
folds AS (
  SELECT *, list_reduce(list_prepend(CASE WHEN hit THEN changed ELSE leaf END, path),
      lambda h, s: sha256(string_split(s, '|')[1] || h || string_split(s, '|')[2])) AS folded_root
  FROM whole)
SELECT doc_id, lang, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folds
"""
