"""Merkle manifest of a dataset: a hash tree per source and one over sources.

Digests are lower-case hex SHA-256, and a parent hashes the joined hex texts
of up to 16 children.  Only every second level is stored (``STEP``): the nodes
of a stored level are grouped into aligned subtrees of 16 * 16, and a subtree
gives one node of the next stored level.  Proofs go the other way: for each
subtree the missing level in between is hashed again from the stored nodes
below it, its siblings go into the proofs of those nodes, and it is dropped.
A proof from a node up to the root is thus put together from one row per
subtree and stored level; no proof of a document is shuffled or stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerotrace.llm.quality import let
from aerotrace.session import drop_staged, stage_table

FANOUT = 16
#: Levels from one stored level to the next.
STEP = 2
SUBTREE = FANOUT ** STEP
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 5


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def joined(nodes: Column, start, size) -> Column:
    """The digests of ``size`` nodes from place ``start`` (0 the first) as one text."""
    start, size = (x if isinstance(x, Column) else F.lit(x) for x in (start, size))
    return F.array_join(F.slice(nodes, start + 1, size), "")


def positions(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``df`` plus ``idx`` (place of the row within its group, from 0) and
    ``n`` (rows of the group), ordered by ``order``.

    Rows are range-sorted by (group, order) and stored with their place in the
    stored partition; one row per partition and group then carries the rows
    ahead, so a group of any size spreads over many tasks."""
    by = [F.col(group), *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    staged = stage_table(ranged, "merkle-order")
    part = F.shiftright("_at", 33).alias("_part")
    staged = staged.withColumn("_part", part)
    parts = staged.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    ahead = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    parts = parts.select("_part", group, "_first", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"),
                         F.sum("_rows").over(whole).alias("n"))
    return staged.join(parts, ["_part", group]).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("idx"), "n")


def subtrees(nodes: DataFrame, carried: list[str] = ()) -> DataFrame:
    """``nodes(grp, idx, n, digest, *carried)`` of one level -> one row per
    aligned subtree: (grp, sub, n, nodes (digests in order), rows (the carried
    columns in order), inner (the digests of the level above))."""
    packed = F.sort_array(F.collect_list(F.struct("idx", "digest", *carried)))
    rows = nodes.groupBy("grp", F.floor(F.col("idx") / SUBTREE).alias("sub"), "n").agg(packed.alias("rows"))
    rows = rows.withColumn("nodes", F.col("rows.digest"))
    runs = F.sequence(F.lit(0), F.floor((F.size("nodes") - 1) / FANOUT).cast("int"))
    inner = F.transform(runs, lambda r: digest(joined(F.col("nodes"), r * FANOUT, FANOUT)))
    return rows.withColumn("inner", inner)


def build(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of the trees of ``leaves(grp, idx, n, digest, ...)``,
    lowest first, and (grp, root) of each tree.

    ``n`` is the number of nodes of the tree on that level.  A tree leaves the
    stored levels when at most 16 nodes remain; its root is then the only
    node, or the hash of the nodes."""
    levels, roots = [leaves], None
    while True:
        level = levels[-1]
        trees = subtrees(level)
        done = trees.where(F.col("n") <= FANOUT).select(
            "grp", F.when(F.col("n") == 1, F.col("nodes")[0]).otherwise(F.col("inner")[0]).alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        if level.agg(F.max("n")).first()[0] is None or level.where(F.col("n") > FANOUT).isEmpty():
            return levels, stage_table(roots, "merkle-roots")
        up = trees.where(F.col("n") > FANOUT).select(
            "grp", F.col("sub").alias("idx"), F.ceil(F.col("n") / SUBTREE).cast("long").alias("n"),
            digest(joined(F.col("inner"), 0, FANOUT)).alias("digest"))
        levels.append(stage_table(up, "merkle-level"))


def _around(nodes: Column, i: Column) -> Column:
    """The run of 16 that holds place ``i``, without it: (left, right) texts."""
    place = i % FANOUT
    return F.struct(joined(nodes, i - place, place).alias("left"), joined(nodes, i + 1, FANOUT - 1 - place).alias("right"))


def proofs(levels: list[DataFrame], above: DataFrame, carried: list[str] = ()) -> DataFrame:
    """(grp, idx, digest, *carried, proof) of every lowest node.

    ``above(grp, top)`` is the proof of each tree's root in the tree over it.
    A proof lists, level by level, the (left, right) siblings of the node's
    run as joined digest texts.  Stored levels are taken from the top: the
    nodes of a subtree get the siblings in their run and in the recomputed
    level between, followed by the proof of the subtree's own node."""
    upper, out = None, None
    for k in reversed(range(len(levels))):
        extra = list(carried) if k == 0 else []
        trees = subtrees(levels[k], extra)
        last = trees.where(F.col("n") <= FANOUT).join(above, "grp").withColumn("rest", F.col("top"))
        if upper is not None:
            parents = upper.select("grp", F.col("idx").alias("sub"), F.col("proof").alias("rest"))
            last = last.drop("top").unionByName(trees.where(F.col("n") > FANOUT).join(parents, ["grp", "sub"]))
        else:
            last = last.drop("top")
        one = F.posexplode("rows").alias("place", "row")
        rows = last.select("grp", "n", "nodes", "inner", "rest", one)
        below = F.when(F.col("n") > 1, F.array(_around(F.col("nodes"), F.col("place"))))
        between = F.when(F.col("n") > FANOUT, F.array(_around(F.col("inner"), F.floor(F.col("place") / FANOUT).cast("int"))))
        none = F.array().cast("array<struct<left:string,right:string>>")
        proof = F.concat(F.coalesce(below, none), F.coalesce(between, none), F.col("rest"))
        out = rows.select("grp", F.col("row.idx").alias("idx"), F.col("row.digest").alias("digest"),
                          *[F.col(f"row.{c}").alias(c) for c in extra], proof.alias("proof"))
        if k:
            upper = stage_table(out.select("grp", "idx", "proof"), "merkle-proofs")
    return out


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda acc, x: digest(x["left"], acc, x["right"]))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), "").cast("binary"), 256)


class Manifest:
    """The trees of a table: ``leaves``, the stored levels and ``root``.

    ``columns`` enter a leaf in the order given, ``by`` names the column whose
    values have a tree each, ``order`` the rows' order inside a tree.  Values
    of ``by`` are ordered null first, then bytewise; null values of ``order``
    come last, and ties are ordered by the leaf, so rows that agree in all
    columns are interchangeable.  ``carry`` are more columns, by name, that
    ``proofs`` returns.  An empty table has no root (None) and no proofs.
    """

    def __init__(self, table: DataFrame, columns: list[str], by: str, order: str, carry: dict[str, Column] | None = None):
        carry = carry or {}
        self.carried = [f"c_{name}" for name in carry]
        group = F.concat(F.lit("="), F.col(by).cast("string"))  # '' is null
        rows = table.select(F.coalesce(group, F.lit("")).alias("grp"), F.col(order).alias("key"),
                            leaf([F.col(c) for c in columns]).alias("digest"),
                            *[value.alias(f"c_{name}") for name, value in carry.items()])
        rows = stage_table(rows, "merkle-leaves")
        placed = positions(rows, "grp", [F.col("key").asc_nulls_last(), F.col("digest")])
        self.leaves = stage_table(placed.drop("key"), "merkle-leaves")
        drop_staged(rows)
        self.levels, roots = build(self.leaves)
        self.subroots = roots.withColumnRenamed("root", "subroot")
        tops = self.subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("subroot").alias("digest"))
        top = stage_table(positions(tops, "grp", [F.col("of")]), "merkle-leaves")
        top_levels, top_root = build(top)
        found = top_root.first()
        self.root = found["root"] if found else None
        nothing = F.array().cast("array<struct<left:string,right:string>>")
        ends = top.select("grp").distinct().withColumn("top", nothing)
        self.above = stage_table(proofs(top_levels, ends, ["of"]).select(
            F.col("of").alias("grp"), F.col("proof").alias("top")), "merkle-above")

    def proofs(self) -> DataFrame:
        """(carried columns, leaf, subroot, proof) of every row."""
        above = self.above.join(self.subroots, "grp").select("grp", "top")
        rows = proofs(self.levels, above, self.carried).join(self.subroots, "grp")
        return rows.select(*[F.col(c).alias(c[2:]) for c in self.carried], F.col("digest").alias("leaf"), "subroot", "proof")


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_check(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified).

    Where 5 divides the unsigned crc32 of the decimal doc_id, the row counts
    as tampered: its leaf is recomputed with A-Z of the text lower-cased, and
    folded with the untampered siblings.  Null fields are ``-`` in the leaf;
    rows without an id are not tampered and come last in their source; texts
    of any length are hashed whole; repeated rows are leaves of their own; an
    empty table gives an empty result; other columns are ignored.
    """
    lower = F.translate("text", UPPER, LOWER)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))
    changed = F.when(hit, leaf([*[F.col(c) for c in COLUMNS[:-1]], lower]))
    m = Manifest(docs, COLUMNS, "source", "doc_id", {"doc_id": F.col("doc_id"), "changed": changed})
    root = F.lit(m.root).cast("string")
    rows = m.proofs().select("doc_id", "leaf", "subroot", root.alias("root"), let(F.col("proof"), lambda p: F.struct(
        proof_digest(p).alias("sha"), fold(F.coalesce("changed", "leaf"), p).alias("folded"))).alias("x"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.col("x.sha").alias("proof_sha256"),
                       F.col("x.folded").alias("folded_root"), (F.col("x.folded") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document."""
    return manifest_check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


_SQL_LEAF = " || ".join(_sql_field(c) for c in COLUMNS)
_SQL_LOWER = _sql_field(f"translate(text, '{UPPER}', '{LOWER}')")
_SQL_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0,0,0,0,0,0,0,0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP13_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, sha256({_SQL_LEAF}) AS leaf,
         CASE WHEN {_SQL_CRC} % {TAMPER_EVERY} = 0
              THEN sha256({" || ".join(_sql_field(c) for c in COLUMNS[:-1])} || {_SQL_LOWER}) END AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS LAST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM rows),
nodes AS (
  SELECT 0 AS lvl, grp, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lvl + 1, grp, idx // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY lvl, grp, n, idx // {FANOUT}),
subroots AS (SELECT grp, lvl AS height, h AS subroot FROM nodes WHERE n = 1),
tops AS (SELECT grp AS of, height, subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS idx, count(*) OVER () AS n FROM subroots),
above AS (
  SELECT 0 AS lvl, idx, n, subroot AS h FROM tops
  UNION ALL
  SELECT lvl + 1, idx // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY idx))
  FROM above WHERE n > 1 GROUP BY lvl, n, idx // {FANOUT}),
every AS (
  SELECT grp, lvl, idx, h FROM nodes WHERE n > 1
  UNION ALL SELECT NULL, lvl, idx, h FROM above WHERE n > 1),
runs AS (SELECT grp, lvl, idx // {FANOUT} AS run, list(h ORDER BY idx) AS hs FROM every GROUP BY grp, lvl, idx // {FANOUT}),
steps AS (
  SELECT l.doc_id, l.grp, l.idx, r.lvl AS step, hs, (l.idx // CAST(pow({FANOUT}, r.lvl) AS BIGINT)) % {FANOUT} AS place
  FROM leaves l JOIN runs r ON r.grp = l.grp AND r.run = l.idx // CAST(pow({FANOUT}, r.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT l.doc_id, l.grp, l.idx, t.height + r.lvl, hs, (t.idx // CAST(pow({FANOUT}, r.lvl) AS BIGINT)) % {FANOUT}
  FROM leaves l JOIN tops t ON t.of = l.grp JOIN runs r ON r.grp IS NULL AND r.run = t.idx // CAST(pow({FANOUT}, r.lvl + 1) AS BIGINT)),
proofs AS (
  SELECT grp, idx, list({{'l': array_to_string(hs[1:place], ''), 'r': array_to_string(hs[place + 2:], '')}} ORDER BY step) AS p
  FROM steps GROUP BY grp, idx),
folded AS (
  SELECT l.grp, l.idx, 0 AS done, coalesce(p.p, []) AS p, coalesce(l.changed, l.leaf) AS h
  FROM leaves l LEFT JOIN proofs p ON p.grp = l.grp AND p.idx = l.idx
  UNION ALL
  SELECT grp, idx, done + 1, p, sha256(p[done + 1].l || h || p[done + 1].r) FROM folded WHERE done < len(p))
SELECT l.doc_id, l.leaf, s.subroot, a.h AS root,
       sha256(array_to_string(list_transform(f.p, lambda x: x.l || x.r), '')) AS proof_sha256, f.h AS folded_root, f.h = a.h AS verified
FROM leaves l JOIN subroots s ON s.grp = l.grp JOIN above a ON a.n = 1 JOIN folded f ON f.grp = l.grp AND f.idx = l.idx AND f.done = len(f.p)
"""
