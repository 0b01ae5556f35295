"""Merkle manifest of a dataset: fanout-8 hash trees per language under one root, and versions by path copying.

H is the lowercase hex sha256 of its inputs end to end, digests as hex text.
A leaf is H of doc_id, source, lang, n_chars and text, each ``-`` if null, else
UTF-8 byte count, ``:``, value.  Per lang, leaves ascend by doc_id; while
several nodes remain, every 8 consecutive ones become their H (the last run may
be shorter, even one).  What remains is the lang's subroot; the subroots, in
the order of lang (null first, bytewise), give the root in the same way.

1. Leaves are hashed by SQL functions and ranked within their lang: repeated
   rows are counted first, the distinct ones range-partitioned by (lang,
   doc_id, leaf) and numbered from the totals of earlier ranges, so neither a
   hot lang nor a hot row meets in one task.
2. Aligned blocks of ``SPAN`` consecutive nodes of one lang become one node each
   (a group of at most ``SPAN`` rows), level after level, until one is left.
   Every level is a written table that all versions share.
3. From the root down each block learns the siblings on its way up (``levels``:
   what lies left and right of it, at most 7 nodes a level).
4. A leaf block is joined with its own way up.  A tampered leaf is a version:
   only its ancestors are copied, inside the block and then on the block's way
   up; all other nodes are the shared ones.  Versions never meet, so any number
   of them may pass the same upper node.

Edge cases: a null doc_id is never tampered and comes first in its lang; a null
text has the field ``-`` and stays as it is when tampered; rows that repeat a
doc_id are leaves of their own, in the order of their hash; equal rows stay as
many leaves; an empty table has no root and no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_written, need, prepare, written

FANOUT = 8
#: Levels inside an aligned block, and the nodes below one.
BLOCK_LEVELS = 3
SPAN = FANOUT ** BLOCK_LEVELS

NODE = "tree string, pos long, hash string"
#: One row per node: the siblings on its way to the root, lowest level first.
WAY = "tree string, pos long, levels array<struct<left: string, right: string>>, subroot string, root string"
PROVEN = ("doc_id long, tree string, pos long, leaf string, subroot string, root string, proof_sha256 string, "
          "copies array<string>, folded_root string")


def leaf_hash(text: Column) -> Column:
    """H of a row's fields with ``text`` in place of its text."""
    fields = [F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), F.col("n_chars").cast("string"), text]
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (rises with lang, null first), leaf, and the leaf after tampering (null where it is not tampered)."""
    rows = need(docs, "doc_id", "source", "lang", "n_chars", "text")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return rows.select("doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
                       leaf_hash(F.col("text")).alias("leaf"), F.when(hit, leaf_hash(lower)).alias("tampered"))


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, str]:
    """``rows``, written, with pos, their rank from 0 within ``tree`` by ``order`` (rows equal in both are equal)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    ranged, path = written(base.repartitionByRange(parts, "tree", *order)
                           .withColumn("part", F.spark_partition_id()), "op12-ranges")
    sums = ranged.groupBy("tree", "part").agg(F.sum("n").alias("held"))
    sums = sums.select(F.col("tree").alias("t"), F.col("part").alias("p"), (F.sum("held").over(
        W.partitionBy("tree").orderBy("part")) - F.col("held")).alias("before"))
    here = W.partitionBy("tree", "part").orderBy(*order)
    first = F.col("before") + F.sum("n").over(here) - F.col("n")
    runs = ranged.join(sums, (F.col("tree") == F.col("t")) & (F.col("part") == F.col("p"))).withColumn("first", first)
    # a row with very many copies is cut into runs, which are dealt out before they become rows
    runs = runs.withColumn("start", F.explode(F.expr(f"sequence(first, first + n - 1, {SPAN}L)")))
    runs = runs.withColumn("end", F.least(F.col("start") + SPAN, F.col("first") + F.col("n")) - 1)
    runs = runs.select(*rows.columns, "start", "end").repartition(parts, "tree", "start")
    out, kept = written(runs.select(*rows.columns, F.explode(F.sequence("start", "end")).alias("pos")), "op12-ranked")
    drop_written(spark, path)
    return out, kept


def _h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def block_levels(nodes: list[str], whole: bool) -> list[list[str]]:
    """The block's nodes and every level above them; a block that is the whole tree stops at its only node."""
    levels = [nodes]
    while len(levels[-1]) > 1 or (not whole and len(levels) <= BLOCK_LEVELS):
        low = levels[-1]
        levels.append([_h(low[i:i + FANOUT]) for i in range(0, len(low), FANOUT)])
    return levels


def _block(table: pa.Table) -> tuple[pa.Table, list[list[str]]]:
    """The block's rows in order, and its levels.  A first block that is not full is the whole tree."""
    table = table.sort_by("pos")
    whole = table.column("pos")[0].as_py() == 0 and table.num_rows < SPAN
    return table, block_levels(table.column("hash").to_pylist(), whole)


def _siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What lies left and right of node ``at`` in its run, on every level below the top."""
    out = []
    for low in levels[:-1]:
        run = at - at % FANOUT
        out.append(("".join(low[run:at]), "".join(low[at + 1:run + FANOUT])))
        at //= FANOUT
    return out


def _folded(node: str, levels: list[tuple[str, str]]) -> list[str]:
    """The copied ancestors of a changed node, one per level."""
    out = []
    for left, right in levels:
        node = _h([left, node, right])
        out.append(node)
    return out


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / SPAN))


def block_roots(nodes: DataFrame) -> DataFrame:
    """One node for every aligned block of each tree."""

    def run(table: pa.Table) -> pa.Table:
        table, levels = _block(table)
        return pa.table({"tree": [table.column("tree")[0].as_py()], "pos": [table.column("block")[0].as_py()],
                         "hash": [levels[-1][0]]})

    return _in_blocks(nodes).groupBy("tree", "block").applyInArrow(run, NODE)


def stages(nodes: DataFrame) -> tuple[list[DataFrame], list[str]]:
    """The written tables of nodes, ``nodes`` first, each one block level higher, until every tree has one node."""
    out, paths = [nodes], []
    while True:
        top, path = written(block_roots(out[-1]), "op12-nodes")
        out.append(top)
        paths.append(path)
        if not (top.agg(F.max("pos")).first()[0] or 0):
            return out, paths


def ways(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The way up of every node, given the way up of every block."""
    up = above.withColumnRenamed("pos", "block")

    def run(low: pa.Table, high: pa.Table) -> pa.Table:
        low, levels = _block(low)
        way = high.to_pylist()[0]
        rest = [(x["left"], x["right"]) for x in way["levels"]]
        rows = [[{"left": a, "right": b} for a, b in _siblings(levels, i) + rest] for i in range(low.num_rows)]
        n = low.num_rows
        return pa.table({"tree": low.column("tree"), "pos": low.column("pos"),
                         "levels": pa.array(rows, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
                         "subroot": pa.array([way["subroot"]] * n, pa.string()),
                         "root": pa.array([way["root"]] * n, pa.string())})

    return _in_blocks(nodes).groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(run, WAY)


def _descend(tables: list[DataFrame], top: DataFrame) -> tuple[DataFrame, list[str]]:
    """The way up of the blocks of ``tables[0]``, from that of the trees' last nodes."""
    way, paths = top, []
    for nodes in reversed(tables[1:-1]):
        way, path = written(ways(nodes, way), "op12-ways")
        paths.append(path)
    return way, paths


def prove(docs: DataFrame) -> DataFrame:
    """Every leaf's place, proof and version: doc_id, tree, pos, leaf, subroot, root, proof_sha256, copies, folded_root.

    ``copies`` are the ancestors that the version of a tampered leaf copied, lowest first,
    its own root last; null where the leaf is not tampered, whose version is the manifest's.
    """
    spark = docs.sparkSession
    prepare(spark)
    base, _ = ranked(leaves(docs), ["doc_id", "leaf"])
    low, gone = stages(base.select("tree", "pos", F.col("leaf").alias("hash")))
    subroots = low[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    subroots, path = ranked(subroots, ["name", "hash"])
    high, more = stages(subroots.select("tree", "pos", "hash"))
    gone += [path, *more]

    none = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    root = high[-1].select("tree", "pos", none.alias("levels"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    way, more = _descend(high, root)
    gone += more
    tops = ways(high[0], way).join(subroots.select("pos", "name", "hash"), "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "levels", F.col("hash").alias("subroot"), "root")
    tops, path = written(tops, "op12-ways")
    way, more = _descend(low, tops)
    gone += [path, *more]

    def run(block: pa.Table, above: pa.Table) -> pa.Table:
        block, levels = _block(block.append_column("hash", block.column("leaf")))
        up = above.to_pylist()[0]
        rest = [(x["left"], x["right"]) for x in up["levels"]]
        proofs, copies, folded = [], [], []
        for i, (leaf, tampered) in enumerate(zip(levels[0], block.column("tampered").to_pylist())):
            siblings = _siblings(levels, i) + rest
            proofs.append(_h([x for pair in siblings for x in pair]))
            path = _folded(tampered or leaf, siblings)
            copies.append(path if tampered else None)
            folded.append(path[-1] if path else tampered or leaf)
        n = block.num_rows
        return pa.table({
            "doc_id": block.column("doc_id"), "tree": block.column("tree"), "pos": block.column("pos"),
            "leaf": block.column("leaf"), "subroot": pa.array([up["subroot"]] * n, pa.string()),
            "root": pa.array([up["root"]] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "copies": pa.array(copies, pa.list_(pa.string())), "folded_root": pa.array(folded, pa.string())})

    out = _in_blocks(base).groupBy("tree", "block").cogroup(
        way.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInArrow(run, PROVEN)
    drop_written(spark, *gone[:-1])  # the result reads the ranked leaves and the last table of ways
    return out


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    return prove(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                              (F.col("folded_root") == F.col("root")).alias("verified"))


#: DuckDB: the same tree by recursion over levels.
ORACLE_SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, text,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
               string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))),
               lambda crc, x: CASE WHEN (xor(crc, x) & 1) = 1
                   THEN xor(xor(crc, x) >> 1, 3988292384::BIGINT) ELSE xor(crc, x) >> 1 END) AS crc
    FROM documents
), l AS (
    SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295::BIGINT) % 3 = 0
                THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS tampered
    FROM d
), a AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l
), up(tree, level, pos, hash) AS (
    SELECT tree, 0, pos, leaf FROM a
    UNION ALL
    SELECT tree, min(level) + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM up
    WHERE tree IN (SELECT tree FROM up GROUP BY tree HAVING count(*) > 1) GROUP BY tree, pos // 8
), t AS (
    SELECT tree, max(level) AS height, arg_max(hash, level) AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place
    FROM up GROUP BY tree
), peak(level, pos, hash) AS (
    SELECT 0, place, subroot FROM t
    UNION ALL
    SELECT min(level) + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM peak
    WHERE (SELECT count(*) FROM peak) > 1 GROUP BY pos // 8
), r AS (SELECT max(level) AS rise, arg_max(hash, level) AS root FROM peak
), nodes AS (
    SELECT up.tree, level, pos, hash FROM up JOIN t ON t.tree = up.tree AND level < height
    UNION ALL
    SELECT t.tree, t.height + peak.level, peak.pos, peak.hash FROM t CROSS JOIN peak
), w AS (
    SELECT a.*, height, subroot, place, rise, root FROM a JOIN t USING (tree) CROSS JOIN r
), step AS (
    SELECT tree, pos, height, place, unnest(range(height + rise)) AS level FROM w
), s AS (
    SELECT tree, pos, level, CASE WHEN level < height THEN pos // (8 ** level)::BIGINT
                                  ELSE place // (8 ** (level - height))::BIGINT END AS at FROM step
), side AS (
    SELECT s.tree, s.pos, s.level, coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (WHERE n.pos < s.at), '') AS l,
           coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (WHERE n.pos > s.at), '') AS r
    FROM s LEFT JOIN nodes n ON n.tree = s.tree AND n.level = s.level AND n.pos // 8 = s.at // 8 AND n.pos <> s.at
    GROUP BY s.tree, s.pos, s.level
), p AS (
    SELECT tree, pos, list({'l': l, 'r': r} ORDER BY level) AS sides, string_agg(l || r, '' ORDER BY level) AS joined
    FROM side GROUP BY tree, pos
), done AS (
    SELECT w.*, sha256(coalesce(joined, '')) AS proof_sha256,
           list_reduce(list_concat([{'l': coalesce(tampered, leaf), 'r': ''}], coalesce(sides, [])),
               lambda x, y: {'l': sha256(y.l || x.l || y.r), 'r': ''}).l AS folded_root
    FROM w LEFT JOIN p USING (tree, pos)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done"""
