"""Merkle manifest of a table: leaf, subtree and root digests, inclusion proofs and their check.

Rows are leaves of one tree a group (here: language); the trees' roots are leaves of one more tree. A run of `fanout` nodes is
hashed into its parent. The method is a slot pivot: conditional aggregates spread the children of a block into columns,
concatenating neighbouring columns hashes them, leaving out the own column gives the siblings. A block is fanout ** steps slots
wide (64 columns at most), so one shuffle makes several levels, and a level is never shuffled on its own.

Cases: null columns are hashed as `-`; null doc_ids come first; rows that repeat a doc_id are leaves of their own, ordered by their
digest; rows that are the same throughout have the same digest, so their order decides nothing. Null languages are one group, the first.
An empty table gives no rows. Columns other than those named take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, save

FANOUT = 2
#: Most columns of one pivot.
SLOTS = 64
#: Columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, colon, value: no two rows have the same concatenation."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields]), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with pos (from 0 in the group, by `order`, nulls first) and n (rows of the group), saved.

    Rows are dealt by ranges of (group, order), so a group of any size is many tasks; what meets in a window is one count for each range.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    ranged = rows.withColumn("__row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*keys, F.col("__row")).sortWithinPartitions(*keys, "__row")
    ranged = save(ranged.drop("__row").withColumn("__at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("__at", 33)
    ranges = ranged.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy("__group")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = save(ranges.withColumns({"__before": F.coalesce(F.sum("__rows").over(before), F.lit(0)), "n": F.sum("__rows").over(whole)}), "ranges")
    few = ranges.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = ranged.withColumn("__p", part).join(F.broadcast(ranges) if few else ranges, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__p") == F.col("__part")))
    return met.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).select(*rows.columns, "pos", "n")


def height(n: Column, fanout: int) -> Column:
    """Levels above the leaves of a tree of n leaves: digits of n - 1 to the base fanout."""
    return F.when(n <= 1, 0).otherwise(F.length(F.conv((n - 1).cast("string"), 10, fanout)))


class Tree:
    """Blocks of all passes, from the leaves up, of trees (gid) over nodes (gid, pos, height, digest)."""

    def __init__(self, nodes: DataFrame, fanout: int, name: str):
        self.fanout = fanout
        self.steps = max(s for s in range(1, 7) if s == 1 or fanout**s <= SLOTS)
        self.slots = fanout**self.steps
        self.blocks: list[DataFrame] = []
        top = nodes.agg(F.max("height")).first()[0] or 0
        for _ in range(-(-top // self.steps)):
            block = save(self._pivot(nodes), name)
            self.blocks.append(block)
            nodes = block.select("gid", F.col("block").alias("pos"), F.greatest(F.col("height") - self.steps, F.lit(0)).alias("height"), F.element_at("levels", self.steps + 1)[0].alias("digest"))
        #: gid, digest: one row a tree.
        self.roots = nodes.select("gid", "digest")

    def _pivot(self, nodes: DataFrame) -> DataFrame:
        """(gid, block, height, levels): one row a block; levels[0] has its nodes, levels[j] those j levels above, up to the tree's height."""
        columns = [F.expr(f"max(CASE WHEN pmod(pos, {self.slots}) = {t} THEN digest END) AS s{t}") for t in range(self.slots)]
        wide = nodes.groupBy("gid", F.expr(f"pos div {self.slots} AS block")).agg(F.max("height").alias("height"), *columns)
        out = wide.selectExpr("gid", "block", "height", f"array_compact(array({', '.join(f's{t}' for t in range(self.slots))})) AS l0")
        for j in range(1, self.steps + 1):
            low = F.col(f"l{j - 1}")
            out = out.withColumn(f"l{j}", F.when(F.col("height") >= j, self._parents(low)).otherwise(low))
        return out.select("gid", "block", "height", F.array(*[f"l{j}" for j in range(self.steps + 1)]).alias("levels"))

    def _parents(self, nodes: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / self.fanout).cast("int") - 1)
        return F.transform(runs, lambda k: F.sha2(F.array_join(F.slice(nodes, k * self.fanout + 1, self.fanout), ""), 256))

    def _siblings(self, slot: Column) -> Column:
        """For each level of a block's row (levels, height) the run's nodes left and right of the node above this slot."""
        pairs = []
        for j in range(self.steps):
            level, own = F.element_at("levels", j + 1), F.floor(slot / self.fanout**j).cast("int")
            at = F.pmod(own, F.lit(self.fanout))
            left, right = F.slice(level, own - at + 1, at), F.slice(level, own + 2, F.lit(self.fanout - 1) - at)
            pairs.append(F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))
        return F.slice(F.array(*pairs), 1, F.least(F.col("height"), F.lit(self.steps)))

    def proofs(self, nodes: DataFrame, above: DataFrame) -> DataFrame:
        """nodes (gid, pos, others) with path, the siblings from the node to the root, and the other columns of above (gid, path, others)."""
        kept = [c for c in above.columns if c not in ("gid", "path")]
        up = above.withColumn("block", F.lit(0).cast("long"))
        for k in reversed(range(len(self.blocks))):
            # up: (gid, block, path above the block) of this pass
            down = self.blocks[k].join(up, ["gid", "block"])
            slot = F.pmod("pos", F.lit(self.slots)).cast("int")
            lower = nodes if k == 0 else self.blocks[k - 1].select("gid", F.col("block").alias("pos"))
            lower = lower.withColumn("__block", F.expr(f"pos div {self.slots}"))
            met = lower.join(down.withColumnsRenamed({"gid": "__gid", "block": "__above"}), (F.col("gid") == F.col("__gid")) & (F.col("__block") == F.col("__above")))
            met = met.withColumn("path", F.concat(self._siblings(slot), "path"))
            up = met.select(*lower.drop("__block").columns, *kept, "path")
            if k:
                up = up.withColumnRenamed("pos", "block")
        if not self.blocks:
            up = nodes.join(up.drop("block"), "gid")
        return up


def manifest(docs: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """(leaves: doc_id, leaf, tampered_leaf, lang, subroot, root, path; groups: gid, lang, n, subroot, root).

    path: array of (left, right), the concatenated siblings of the leaf's ancestors on each level, from the leaf to the root.
    tampered_leaf: the leaf's digest after a change of n_chars by one (null where n_chars is).
    """
    fields = [F.col(c) for c in FIELDS]
    other = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    leaves = docs.select("doc_id", "lang", leaf_digest(fields).alias("leaf"), F.when(changed & F.col("n_chars").isNotNull(), leaf_digest(other)).alias("tampered_leaf"))
    leaves = save(numbered(save(leaves, "digests"), "lang", ["doc_id", "leaf"]), "leaves")  # ranges are sampled from digests, not from texts
    groups = leaves.groupBy("lang").agg(F.first("n").alias("leaves"))
    groups = save(numbered(groups.withColumn("__one", F.lit(1)), "__one", ["lang"]).withColumnsRenamed({"pos": "gid", "n": "groups"}), "groups")
    few = groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    names = groups.select("gid", F.col("lang").alias("__lang"))
    own = leaves.join(F.broadcast(names) if few else names, F.col("lang").eqNullSafe(F.col("__lang"))).drop("__lang")
    nodes = own.select("doc_id", "lang", "leaf", "tampered_leaf", "gid", "pos", height(F.col("n"), fanout).alias("height"))
    tree = Tree(nodes.select("gid", "pos", "height", F.col("leaf").alias("digest")), fanout, "blocks")
    subroots = save(tree.roots.join(groups, "gid").select("gid", "lang", F.col("digest").alias("subroot"), height(F.col("groups"), fanout).alias("height"), F.col("leaves").alias("n")), "subroots")
    head = F.lit(0).cast("long")
    top = Tree(subroots.select(head.alias("gid"), F.col("gid").alias("pos"), "height", F.col("subroot").alias("digest")), fanout, "top")
    none = F.array().cast("array<struct<left:string,right:string>>")
    root = top.roots.select("gid", F.col("digest").alias("root"), none.alias("path"))
    placed = top.proofs(subroots.select(head.alias("gid"), F.col("gid").alias("pos"), "lang", "n", "subroot"), root)
    placed = save(placed.select(F.col("pos").alias("gid"), "lang", "n", "subroot", "root", "path"), "placed")
    out = tree.proofs(nodes.drop("height"), placed.select("gid", "subroot", "root", "path"))
    return out.select("doc_id", "leaf", "tampered_leaf", "lang", "subroot", "root", "path"), placed.drop("path")


def proof_digest(path: Column) -> Column:
    """H of all siblings, from the leaf's level to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def verify(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: tampered rows fold their changed leaf."""
    leaves, _ = manifest(docs, fanout)
    out = leaves.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.coalesce("tampered_leaf", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_VALUES = "||".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", "{N}::VARCHAR", "text"))
#: Nodes of both kinds of trees level by level; crc32 by its table of 256 remainders, byte by byte.
ORACLE = f"""WITH RECURSIVE bits(i, b, c) AS (SELECT 0, range, range FROM range(256)
  UNION ALL SELECT i + 1, b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE i < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
d AS MATERIALIZED (SELECT *, sha256({_VALUES.replace("{N}", "n_chars")}) AS leaf,
    xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda a, x: xor(t[xor(a & 255, x) + 1], a >> 8), 4294967295)) % 7 = 0 AS hit
  FROM documents, crc),
p AS MATERIALIZED (SELECT doc_id, leaf, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n, CASE WHEN hit AND n_chars IS NOT NULL THEN sha256({_VALUES.replace("{N}", "(n_chars + 1)")}) ELSE leaf END AS tampered FROM d),
tree AS (SELECT g, 0 AS lvl, pos, leaf AS h, n FROM p
  UNION ALL SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY g, lvl, pos // 2),
sub AS MATERIALIZED (SELECT g, lvl AS height, h AS subroot, (SELECT count(DISTINCT g) FROM p) AS n FROM tree WHERE n = 1),
top AS (SELECT 0 AS lvl, g AS pos, subroot AS h, n FROM sub
  UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS MATERIALIZED (
  SELECT p.g, p.pos, a.lvl AS k, (p.pos >> a.lvl) % 2 = 1 AS below, s.h FROM p JOIN (SELECT DISTINCT g, lvl FROM tree WHERE n > 1) a ON a.g = p.g
    LEFT JOIN tree s ON s.g = p.g AND s.lvl = a.lvl AND s.pos = xor(p.pos >> a.lvl, 1)
  UNION ALL SELECT p.g, p.pos, sub.height + a.lvl, (p.g >> a.lvl) % 2 = 1, s.h FROM p JOIN sub ON sub.g = p.g, (SELECT DISTINCT lvl FROM top WHERE n > 1) a
    LEFT JOIN top s ON s.lvl = a.lvl AND s.pos = xor(p.g >> a.lvl, 1)),
fold AS (SELECT g, pos, 0 AS k, tampered AS h FROM p
  UNION ALL SELECT f.g, f.pos, f.k + 1, sha256(CASE WHEN s.below THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END) FROM fold f JOIN steps s ON s.g = f.g AND s.pos = f.pos AND s.k = f.k),
proof AS (SELECT g, pos, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof FROM p LEFT JOIN steps USING (g, pos) GROUP BY g, pos),
done AS (SELECT g, pos, max_by(h, k) AS folded_root FROM fold GROUP BY g, pos)
SELECT doc_id, leaf, subroot, root, proof AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN sub USING (g) JOIN proof USING (g, pos) JOIN done USING (g, pos), (SELECT h AS root FROM top WHERE n = 1)"""
