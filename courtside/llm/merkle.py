"""Merkle manifest of a dataset: a content-addressed DAG over its rows, with proofs by descent.

Every row is a leaf: the SHA-256 of its fields in a fixed byte form. Per source, leaves in order of
their ids are hashed sixteen at a time, level by level, to the source's subroot; the subroots, in
order of the sources, likewise to the root. ``build`` stores the DAG as a table of records
``digest -> children`` (equal nodes are stored once) and a table of heads, one a source.

``prove`` answers requests for leaves by descent: requests start at the root, and each step joins
their digests with the records of one height, splits the children by the next digit of the
rank into the child to follow and the unselected ones, and keeps the latter as a segment of the
path. Requests that share digits travel as one until they part, so a step carries one request a
node and no digest is hot. At the leaves, the segments are read in reverse: from leaf to root.

Ranks come from range partitions of (source, id), counted per partition and source, so that a
source that holds most rows lies in many partitions. Nodes of a level are grouped by source and
rank / 16: at most sixteen rows a group. All is DataFrame functions; the texts are read once and
only digests move.

Defined cases: a null field is ``-``; a null source is a source of its own and comes first. Null
ids come first in their source; rows with equal ids are ordered by their leaf, and rows that are
equal in all five fields are interchangeable. A row with a null id is never tampered with. A source
of one row has its leaf as subroot; one source alone has its subroot as root. An empty table
gives an empty result. Texts are hashed whole, however long. Columns besides the five are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import cut
from courtside.session import scratch_path

FANOUT = 16
#: Rows that one range partition of the ranking holds.
PART_ROWS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A field's bytes: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def tampered_text(doc_id: Column, text: Column, modulus: int = 5) -> Column:
    """``text`` with A-Z lower-cased where ``modulus`` divides the CRC-32 of the id's digits."""
    return F.when(F.crc32(doc_id.cast("string")) % modulus == 0, F.translate(text, UPPER, LOWER)).otherwise(text)


def digests(nodes: Column) -> Column:
    """The digests of an array of nodes, one after another."""
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def ranked(rows: DataFrame, group: str, order: list[str], total: int) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order``) and ``of`` (rows) within their ``group``.

    Rows are dealt by ranges of (group, order) and numbered as they lie; one small row a partition
    and group says how many came before, so no partition must hold a whole group."""
    parts = 1 + total // PART_ROWS
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    laid = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    laid = cut(laid.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()))
    own = laid.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part")
    own = own.select(F.col("_part").alias("_p"), F.col(group).alias("_g"), "_first",
                     F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                     F.sum("_n").over(Window.partitionBy(group)).alias("of"))
    on = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return laid.join(own, on).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_p", "_g", "_first", "_before")


def heights(n: int) -> int:
    """Levels of runs over ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def height_of(n: Column, most: int) -> Column:
    """``heights`` as a column, for counts whose height is ``most`` at most."""
    out = F.lit(most)
    for h in range(most - 1, -1, -1):
        out = F.when(n <= FANOUT**h, F.lit(h)).otherwise(out)
    return out.cast("int")


def tree(leaves: DataFrame, most: int, tag: str, path: str) -> DataFrame:
    """Hash ``leaves`` (``key, rank, of, digest``) level by level; write the records of height h
    to ``path/tree=tag/height=h`` and return ``key, of, digest`` of each key's top node."""
    level = leaves.select("key", "of", F.col("of").alias("nodes"), "rank", "digest")
    tops = level.where("nodes <= 1").select("key", "of", "digest")
    for h in range(1, most + 1):
        runs = (level.where("nodes > 1").groupBy("key", "of", "nodes", F.expr(f"rank div {FANOUT}").alias("run"))
                .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("children")))
        made = runs.select("key", "of", F.expr(f"(nodes + {FANOUT - 1}) div {FANOUT}").alias("nodes"), F.col("run").alias("rank"),
                           F.sha2(digests(F.col("children")), 256).alias("digest"), F.transform("children", lambda x: x["digest"]).alias("children"))
        at = f"{path}/tree={tag}/height={h}"
        made.write.parquet(at)
        level = leaves.sparkSession.read.parquet(at)
        tops = tops.unionByName(level.where("nodes = 1").select("key", "of", "digest"))
        level = level.drop("children")
    return tops


class Manifest:
    """A stored DAG: ``records(tag, height)``, ``heads`` (a row a source) and ``root``."""

    def __init__(self, path: str, leaves: DataFrame, heads: DataFrame, top: DataFrame, source_height: int, row_height: int) -> None:
        self.path, self.leaves, self.heads, self.top = path, leaves, heads, top
        self.source_height, self.row_height = source_height, row_height

    def records(self, tag: str, height: int) -> DataFrame:
        """Digest and children of the nodes of one height; equal nodes once."""
        rows = self.leaves.sparkSession.read.parquet(f"{self.path}/tree={tag}/height={height}")
        return rows.select("digest", "children").dropDuplicates(["digest"])


def build(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", n_col: str = "n_chars", text_col: str = "text") -> Manifest:
    """Hash ``docs`` and store the DAG in the session's shared folder."""
    own = [F.col(c) for c in (id_col, source_col, lang_col, n_col)]
    text = F.col(text_col)
    leaves = cut(docs.select(own[0].cast("long").alias("doc_id"), own[1].alias("source"), leaf_digest(*own, text).alias("digest"),
                             leaf_digest(*own, tampered_text(own[0], text)).alias("tampered"), F.monotonically_increasing_id().alias("row")))
    spark = docs.sparkSession
    path = scratch_path(spark, "merkle")
    total = leaves.count()
    placed = ranked(leaves, "source", ["doc_id", "digest", "row"], total).drop("row")
    sources = placed.where("rank = 0").select("source", "of")
    n_sources = sources.count()
    most = placed.agg(F.max("of")).first()[0] or 0
    # a source's place in the order of sources is its key from here on
    keyed = ranked(sources.withColumnRenamed("of", "rows").withColumn("all", F.lit(0)), "all", ["source"], n_sources)
    keyed = cut(keyed.select(F.col("source").alias("_source"), F.col("rank").alias("key")))
    placed = placed.join(keyed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed.write.parquet(f"{path}/leaves")
    placed = spark.read.parquet(f"{path}/leaves")
    row_height, source_height = heights(most), heights(n_sources)
    heads = cut(tree(placed, row_height, "rows", path).withColumn("height", height_of(F.col("of"), row_height)))
    subroots = heads.select(F.lit(0).cast("long").alias("key"), F.col("key").alias("rank"), F.lit(n_sources).cast("long").alias("of"), "digest")
    top = cut(tree(subroots, source_height, "sources", path).select("digest"))
    return Manifest(path, placed, heads, top, source_height, row_height)


def others(digit: Column) -> Column:
    """Of a column ``children``: the digests to the left and to the right of the one at ``digit``."""
    left, right = F.slice("children", F.lit(1), digit), F.slice("children", digit + 2, F.size("children"))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def descend(requests: DataFrame, records: DataFrame) -> DataFrame:
    """One step down: each request (``digest, key, rank, subroot, path``) becomes one for each child
    of its node, with the unselected children as a new segment."""
    known = records.select(F.col("digest").alias("_node"), "children")
    met = requests.join(known, F.col("digest") == F.col("_node"))
    split = met.select("key", "rank", "subroot", "path", "children", F.posexplode("children").alias("digit", "child"))
    return split.select(F.col("child").alias("digest"), "key", (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), "subroot",
                        F.concat("path", F.array(others(F.col("digit")))).alias("path"))


def prove(manifest: Manifest) -> DataFrame:
    """``doc_id, source, leaf, tampered, subroot, root, path`` for every leaf of the manifest. ``path``
    has a segment a level, from leaf to root: the digests to the left and right of the node."""
    no_path = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    zero = F.lit(0).cast("long")
    at = manifest.top.select("digest", zero.alias("key"), zero.alias("rank"), F.lit("").alias("subroot"), no_path.alias("path"))
    for h in range(manifest.source_height, 0, -1):
        at = cut(descend(at, manifest.records("sources", h)))
    # a source's requests enter its own tree at the height of its subroot
    heads = manifest.heads.select(F.col("key").alias("_key"), "height")
    entered = cut(at.join(heads, F.col("rank") == F.col("_key"))
                  .select("digest", F.col("_key").alias("key"), zero.alias("rank"), F.col("digest").alias("subroot"), "path", "height"))
    at = entered.where(F.col("height") == manifest.row_height).drop("height")
    for h in range(manifest.row_height, 1, -1):
        at = cut(descend(at, manifest.records("rows", h)).unionByName(entered.where(F.col("height") == h - 1).drop("height")))
    # the last step meets a run's requests as one row of sixteen at most, so a path isn't shuffled for each
    lone = entered.where("height = 0").select("key", "rank", "subroot", "path", F.array("digest").alias("children"), F.lit(False).alias("in_run"))
    if manifest.row_height:
        known = manifest.records("rows", 1).select(F.col("digest").alias("_node"), "children")
        runs = at.join(known, F.col("digest") == F.col("_node")).select("key", "rank", "subroot", "path", "children", F.lit(True).alias("in_run"))
        lone = runs.unionByName(lone)
    batch = (manifest.leaves.groupBy(F.col("key").alias("_key"), F.expr(f"rank div {FANOUT}").alias("_run"))
             .agg(F.collect_list(F.struct("rank", "doc_id", "source", "tampered")).alias("asked")))
    met = lone.join(batch, (F.col("key") == F.col("_key")) & (F.col("rank") == F.col("_run")))
    asked = (met.select("subroot", "path", "children", "in_run", F.explode("asked").alias("a"))
             .withColumn("digit", F.expr(f"cast(a.rank % {FANOUT} as int)")))
    path = F.reverse(F.when(F.col("in_run"), F.concat("path", F.array(others(F.col("digit"))))).otherwise(F.col("path")))
    root = manifest.top.first()
    return asked.select(F.col("a.doc_id").alias("doc_id"), F.col("a.source").alias("source"), F.get("children", F.col("digit")).alias("leaf"),
                        F.col("a.tampered").alias("tampered"), "subroot", F.lit(root and root["digest"]).cast("string").alias("root"), path.alias("path"))


def fold(start: Column, path: Column) -> Column:
    """The root that the digest ``start`` gives with a path."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def verify(proofs: DataFrame) -> DataFrame:
    """``proofs`` with the digest of the path and the root that the (perhaps tampered) leaf gives."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return (proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), fold(F.col("tampered"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle(levels: int = 7) -> str:
    """The manifest in SQL, level by level and without descent; ``levels`` levels reach 16^levels rows."""
    field = "COALESCE(CAST(STRLEN({0}) AS VARCHAR) || ':' || {0}, '-')"
    def leaf(text: str) -> str:
        return "SHA256(" + " || ".join(field.format(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    # CRC-32 bit by bit: a digit's code is mixed in, then eight shifts (-1)
    steps = "LIST_CONCAT([CAST(4294967295 AS BIGINT)], FLATTEN(LIST_TRANSFORM(STRING_SPLIT(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ORD(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])))"
    crc = f"XOR(LIST_REDUCE({steps}, lambda a, b: CASE WHEN b >= 0 THEN XOR(a, b) WHEN a & 1 = 1 THEN XOR(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END), CAST(4294967295 AS BIGINT))"
    parts = [f"""WITH base AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(f"TRANSLATE(text, '{UPPER}', '{LOWER}')")} AS low, doc_id IS NOT NULL AND {crc} % 5 = 0 AS hit FROM documents),
placed AS (
  SELECT doc_id, source, leaf, CASE WHEN hit THEN low ELSE leaf END AS tampered,
         ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, CASE WHEN hit THEN low ELSE leaf END) - 1 AS rank,
         DENSE_RANK() OVER (ORDER BY source NULLS FIRST) - 1 AS key FROM base),
n0 AS (SELECT key, rank, leaf AS digest FROM placed)"""]
    def climb(nodes: str, h: int, group: str) -> str:
        by = f"PARTITION BY {group}" if group else ""
        keys = f"{group}, " if group else ""
        return f"""
{nodes}{h + 1} AS (
  SELECT {keys}CASE WHEN many THEN rank // 16 ELSE rank END AS rank, CASE WHEN ANY_VALUE(many) THEN SHA256(STRING_AGG(digest, '' ORDER BY rank)) ELSE ANY_VALUE(digest) END AS digest
  FROM (SELECT *, COUNT(*) OVER ({by}) > 1 AS many FROM {nodes}{h}) GROUP BY {keys}CASE WHEN many THEN rank // 16 ELSE rank END)"""
    parts += [climb("n", h, "key") for h in range(levels)]
    parts.append(f"\ns0 AS (SELECT key AS rank, digest FROM n{levels})")
    parts += [climb("s", h, "") for h in range(levels)]
    # walking up from each leaf: the run's other nodes to the left and right
    parts.append("\nw0 AS (SELECT *, rank AS spot, tampered AS folded, '' AS proof FROM placed)")
    for t, (nodes, group) in enumerate((("n", "key"), ("s", ""))):
        for h in range(levels):
            step, on = t * levels + h, "x.key = w.key AND " if group else ""
            if t and not h:
                parts.append(f"\nv{step} AS (SELECT * REPLACE (key AS spot) FROM w{step})")
            came = f"v{step}" if t and not h else f"w{step}"
            counted = f"\nc{step} AS (SELECT {group + ', ' if group else ''}COUNT(*) AS many FROM {nodes}{h}{' GROUP BY key' if group else ''})"
            parts.append(counted)
            sides = f"""
b{step} AS (
  SELECT w.key, w.spot, COALESCE(STRING_AGG(x.digest, '' ORDER BY x.rank) FILTER (WHERE x.rank < w.spot), '') AS l, COALESCE(STRING_AGG(x.digest, '' ORDER BY x.rank) FILTER (WHERE x.rank > w.spot), '') AS r
  FROM (SELECT DISTINCT key, spot FROM {came}) w JOIN {nodes}{h} x ON {on}x.rank // 16 = w.spot // 16 GROUP BY w.key, w.spot)"""
            parts.append(sides)
            parts.append(f"""
w{step + 1} AS (
  SELECT w.* REPLACE (CASE WHEN c.many > 1 THEN w.spot // 16 ELSE w.spot END AS spot, CASE WHEN c.many > 1 THEN SHA256(b.l || w.folded || b.r) ELSE w.folded END AS folded,
                      CASE WHEN c.many > 1 THEN w.proof || b.l || b.r ELSE w.proof END AS proof)
  FROM {came} w JOIN b{step} b ON b.key = w.key AND b.spot = w.spot JOIN c{step} c ON {'c.key = w.key' if group else 'TRUE'})""")
    last = 2 * levels
    return ",".join(parts) + f"""
SELECT w.doc_id, w.leaf, n.digest AS subroot, s.digest AS root, SHA256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = s.digest AS verified
FROM w{last} w JOIN n{levels} n ON n.key = w.key CROSS JOIN s{levels} s"""
