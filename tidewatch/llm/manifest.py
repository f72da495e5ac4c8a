"""Operator 13: Merkle manifest of a dataset, with leaf coordinates by bitmap ranks.

Leaves.  A row's leaf is H, the SHA-256 in lowercase hex, of its fields: ``-`` for
null, else the UTF-8 byte count, ``:`` and the value (integers in decimal).

Coordinates.  Within a group, leaves ascend by id, and nothing is sorted to find
their places: every task sets the ids' bits, 64 to a word, and words are merged
by ``bit_or``; 64 words make a container that stores the words that are not zero,
a mask that says which, and a directory of the popcounts before each.  Containers
are range-dealt, and running sums over the dealt parts, then inside a part, give
each container's base.  A row's place is its container's base, the directory entry
of its word and the popcount of the lower bits.  Ids with more than one row add
what they have too much to a list of their container; their rows, and only
those, are placed by two-level running counts over (leaf, row).

Levels.  A place determines a slot: ``place div 4096`` is the chunk, and a task
puts the chunk's hashes in an array by their places, reduces four levels of
eights in it and hands one hash on to the next tier, until a group has one node.
Subroots are nodes of a last tree over the groups in order.  On the way back each
chunk gets the siblings of its own node on all upper levels, so a leaf's proof is
made where the leaf lies.

Cases: a null id counts as an id before all others and as '' in ``crc32``; null
groups are one group, first; equal ids are ordered by their leaves, equal rows are
interchangeable; empty and long texts are fields like any other; a group of one
row has its leaf as subroot, a table of one group its subroot as root; without any
sibling the proof is H of nothing; an empty table gives an empty result.  No list
holds more than 4,096 rows of the table, or one hash of each level.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.llm.common import materialise, prepare, shuffle_partitions

ARITY = 8
#: Levels that one task reduces, of ARITY ** LEVELS nodes.
LEVELS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(c: Column) -> Column:
    """``-`` or byte count, colon, value."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def group_name(c: Column) -> Column:
    """A group's name without null; names sort as the groups do, null first."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def leaves(docs: DataFrame, id_col: str, group_col: str, fields: tuple[str, ...], audited: dict[str, Column] | None = None,
           tampered: Column | None = None) -> DataFrame:
    """``doc_id, g, has, bucket, low, row, leaf, other``, stored.

    ``other``: where ``tampered`` holds, the leaf with the columns in ``audited``
    in place of the fields; else null.
    """
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(tampered, leaf(*[(audited or {}).get(f, F.col(f)) for f in fields]))
    doc_id = F.col(id_col).cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), group_name(F.col(group_col)).alias("g"), doc_id.isNotNull().alias("has"),
                       F.coalesce(doc_id, F.lit(0)).alias("i"), F.monotonically_increasing_id().alias("row"),
                       leaf(*map(F.col, fields)).alias("leaf"), other.alias("other"))
    return materialise(rows.select("doc_id", "g", "has", F.shiftright("i", 12).alias("bucket"),
                                   F.col("i").bitwiseAND(4095).cast("int").alias("low"), "row", "leaf", "other"), "leaves")


# -- places ---------------------------------------------------------------------

KEY = ["g", "has", "bucket"]


def containers(rows: DataFrame) -> DataFrame:
    """Compressed bitmaps of 4,096 ids: ``g, has, bucket, mask, bits, before, extra, total``."""
    ids = rows.groupBy(*KEY, "low").agg(F.count(F.lit(1)).alias("m"))
    words = ids.groupBy(*KEY, F.shiftright("low", 6).alias("word")).agg(
        F.bit_or(_bit(F.col("low").bitwiseAND(63))).alias("bits"), F.sum("m").alias("total"),
        F.collect_list(F.when(F.col("m") > 1, F.struct("low", (F.col("m") - 1).alias("more")))).alias("extra"))   # at most 64
    kept = words.groupBy(*KEY).agg(
        F.bit_or(_bit(F.col("word"))).alias("mask"), F.sum("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"),   # at most 64
        F.flatten(F.collect_list("extra")).alias("extra"))
    count = lambda upto: F.aggregate(F.slice("words", 1, upto), F.lit(0), lambda s, w: s + F.bit_count(w["bits"]))
    return kept.select(*KEY, "mask", F.col("words.bits").alias("bits"),
                       F.transform("words", lambda w, i: count(i)).alias("before"), "extra", "total")


def with_bases(found: DataFrame) -> DataFrame:
    """Containers with ``base`` (rows of the group before it) and ``n`` (rows of the group)."""
    spark = found.sparkSession
    dealt = materialise(found.repartitionByRange(shuffle_partitions(spark), *KEY).withColumn(
        "part", F.spark_partition_id()), "containers")
    sums = dealt.groupBy("g", "part").agg(F.sum("total").alias("rows"))   # a row for each part that a group has
    whole = W.partitionBy("g")
    earlier = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("g", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"),
                          F.sum("rows").over(whole).alias("n"))
    inside = W.partitionBy("g", "part").orderBy("has", "bucket").rowsBetween(W.unboundedPreceding, -1)
    return dealt.withColumn("inside", F.coalesce(F.sum("total").over(inside), F.lit(0))).join(offsets, ["g", "part"]).select(
        *KEY, "mask", "bits", "before", "extra", (F.col("offset") + F.col("inside")).alias("base"), "n")


def _below(word: Column, bit: Column) -> Column:
    """The bits of a word below a bit."""
    return word.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bit)))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number)


def running(df: DataFrame, keys: list[str], slice_of: Column, order: list[str], amount: Column) -> DataFrame:
    """``df`` with ``start``: the sum of ``amount`` over the rows of the same keys
    that come before, by slice and then by ``order``.  Sums by slice first, so a
    key's rows are spread over as many groups as it has slices."""
    sliced = df.withColumn("slice", slice_of).withColumn("amount", amount)
    earlier = W.partitionBy(*keys).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    sums = sliced.groupBy(*keys, "slice").agg(F.sum("amount").alias("sum"))
    offsets = sums.select(*keys, "slice", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy(*keys, "slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (sliced.withColumn("inside", F.coalesce(F.sum("amount").over(inside), F.lit(0)))
            .join(offsets, [*keys, "slice"]).withColumn("start", F.col("offset") + F.col("inside"))
            .drop("slice", "amount", "inside", "offset"))


def places(rows: DataFrame) -> DataFrame:
    """The leaves with ``place`` (from 0, in their group) and ``n``, stored."""
    held = with_bases(containers(rows))
    word, bit = F.shiftright("low", 6), F.col("low").bitwiseAND(63)
    at = F.bit_count(_below(F.col("mask"), word))
    more = F.aggregate(F.filter("extra", lambda e: e["low"] < F.col("low")), F.lit(0).cast("bigint"), lambda s, e: s + e["more"])
    rank = F.col("base") + F.get("before", at) + F.bit_count(_below(F.get("bits", at), bit)) + more
    ranked = materialise(rows.join(held, KEY).select(
        "doc_id", "g", "has", "bucket", "low", "row", "leaf", "other", "n", rank.cast("bigint").alias("rank"),
        F.exists("extra", lambda e: e["low"] == F.col("low")).alias("repeated")), "ranked")
    own = [*KEY, "low"]
    again = ranked.where("repeated")
    prefix = lambda c: F.conv(F.substring(F.hex(c), 1, 3), 16, 10).cast("int")
    distinct = again.groupBy(*own, "leaf").agg(F.count(F.lit(1)).alias("m"))
    starts = running(distinct, own, prefix(F.col("leaf")), ["leaf"], F.col("m")).select(*own, "leaf", F.col("start").alias("first"))
    spread = F.pmod(F.xxhash64("row"), F.lit(4096)).cast("int")
    among = running(again, [*own, "leaf"], spread, ["row"], F.lit(1)).join(starts, [*own, "leaf"])
    out = ["doc_id", "g", "leaf", "other", "n"]
    found = ranked.where(~F.col("repeated")).select(*out, F.col("rank").alias("place")).unionByName(
        among.select(*out, (F.col("rank") + F.col("first") + F.col("start")).alias("place")))
    return materialise(found, "places")


# -- levels ---------------------------------------------------------------------

NODE = "g string, place bigint, n bigint, hash binary"


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above n nodes."""
    d = 0
    while n > 1:
        n, d = -(-n // ARITY), d + 1
    return d


def _levels(nodes: pa.Table, deep: int) -> tuple[list[list[str]], int]:
    """The levels of a chunk, its own nodes in their slots first; its first place."""
    at, n = nodes.column("place").to_pylist(), nodes.column("n")[0].as_py()
    first = at[0] - at[0] % ARITY ** deep
    level = [""] * len(at)
    for p, h in zip(at, nodes.column("hash").to_pylist()):
        level[p - first] = h.hex()
    levels = [level]
    for _ in range(min(deep, depth(n))):
        level = [_h("".join(level[i:i + ARITY])) for i in range(0, len(level), ARITY)]
        levels.append(level)
    return levels, first


def _siblings(levels: list[list[str]], up: list[str]) -> list[list[str]]:
    """For each node of a chunk the siblings left and right of its path, lowest level first, ``up`` last."""
    above = [up]
    for level in reversed(levels[:-1]):
        runs = [level[i:i + ARITY] for i in range(0, len(level), ARITY)]
        above = [["".join(run[:k]), "".join(run[k + 1:]), *above[r]] for r, run in enumerate(runs) for k in range(len(run))]
    return above


def _reduced(deep: int):
    def run(key, nodes):
        levels, first = _levels(nodes, deep)
        size = ARITY ** deep
        return pa.table({"g": [key[0].as_py()], "place": [first // size], "n": [-(-nodes.column("n")[0].as_py() // size)],
                         "hash": [bytes.fromhex(levels[-1][0])]})
    return run


def _paths(deep: int):
    def run(key, nodes, above):
        levels, first = _levels(nodes, deep)
        paths = _siblings(levels, above.column("path")[0].as_py())
        return pa.table({"g": [key[0].as_py()] * len(paths), "place": [first + i for i in range(len(paths))],
                         "top": [above.column("top")[0].as_py()] * len(paths), "path": pa.array(paths, pa.list_(pa.string()))})
    return run


def _chunked(nodes: DataFrame, deep: int):
    return nodes.groupBy("g", F.expr(f"place div {ARITY ** deep}").alias("chunk"))


def _climb(nodes: DataFrame, deep: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers from ``nodes`` up, and the one node that each group ends with."""
    tiers, top = [], nodes
    while (top.agg(F.max("n")).first()[0] or 0) > 1:   # one round for each 4,096-fold of the largest group
        tiers.append(top)
        top = materialise(_chunked(top, deep).applyInArrow(_reduced(deep), NODE), "tier")
    return tiers, top


def _descend(tiers: list[DataFrame], paths: DataFrame, deep: int) -> DataFrame:
    """``g, place, top, path`` of the nodes of the lowest tier, from those of each group's last node."""
    for nodes in reversed(tiers):
        parents = paths.select("g", F.col("place").alias("chunk"), "top", "path").groupBy("g", "chunk")
        paths = materialise(_chunked(nodes, deep).cogroup(parents).applyInArrow(
            _paths(deep), "g string, place bigint, top binary, path array<string>"), "paths")
    return paths


def _group_nodes(subroots: DataFrame) -> DataFrame:
    """The groups' last nodes as nodes of one tree: ``name`` beside the columns of a node."""
    dealt = materialise(subroots.select(F.col("g").alias("name"), "hash").repartitionByRange(
        shuffle_partitions(subroots.sparkSession), "name").withColumn("part", F.spark_partition_id()), "groups")
    sums = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))   # one row a shuffle partition
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"),
                          F.sum("rows").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("n"))
    at = F.col("offset") + F.row_number().over(W.partitionBy("part").orderBy("name")) - 1
    return materialise(dealt.join(offsets, "part").select(
        "name", F.lit("").alias("g"), at.cast("bigint").alias("place"), "n", "hash"), "group-nodes")


OUT = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _audit(root: str | None, deep: int):
    def run(key, rows, above):
        levels, first = _levels(rows, deep)
        paths = _siblings(levels, above.column("path")[0].as_py())
        proofs, folded = [], []
        for p, own, other in zip(rows.column("place").to_pylist(), rows.column("hash").to_pylist(), rows.column("other").to_pylist()):
            path = paths[p - first]
            proofs.append(_h("".join(path)))
            h = (own if other is None else other).hex()
            for left, right in zip(path[::2], path[1::2]):
                h = _h(left + h + right)
            folded.append(h)
        n = len(proofs)
        return pa.table({"doc_id": rows.column("doc_id"), "leaf": [h.hex() for h in rows.column("hash").to_pylist()],
                         "subroot": [above.column("top")[0].as_py().hex()] * n, "root": pa.array([root] * n, pa.string()),
                         "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})
    return run


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             audited: dict[str, Column] | None = None, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    The tree is built over the rows as they are.  ``folded_root`` is the root that
    follows from a row's own path: from its leaf, or, where ``tampered`` holds,
    from the leaf with the columns of ``audited`` in place of its fields.  A task
    holds ``8 ** levels`` nodes.
    """
    prepare(docs.sparkSession)
    placed = places(leaves(docs, id_col, group_col, fields, audited, tampered)).withColumnRenamed("leaf", "hash")
    tiers, subroots = _climb(placed.select("g", "place", "n", "hash"), levels)
    groups = _group_nodes(subroots)
    group_tiers, last = _climb(groups.select("g", "place", "n", "hash"), levels)
    top = last.first()   # one row
    root = top["hash"].hex() if top else None
    last = last.select("g", "place", F.col("hash").alias("top"), F.array().cast("array<string>").alias("path"))
    above = _descend(group_tiers, last, levels).join(groups.select("place", "name", "hash"), "place").select(
        F.col("name").alias("g"), F.lit(0).cast("bigint").alias("place"), F.col("hash").alias("top"), "path")
    parents = _descend(tiers[1:], above, levels).select("g", F.col("place").alias("chunk"), "top", "path").groupBy("g", "chunk")
    return _chunked(placed, levels).cogroup(parents).applyInArrow(_audit(root, levels), OUT)


def lowered(text: Column) -> Column:
    """Text with A-Z in lower case."""
    return F.translate(text.cast("string"), _UPPER, _LOWER)


def oracle_sql(levels: int = 8, group_levels: int = 3) -> str:
    """The manifest in DuckDB SQL, for up to 8**levels rows of a lang and 8**group_levels langs."""
    part = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    text = lambda c: part(f"CAST({c} AS VARCHAR)")
    head = " || ".join([text("doc_id"), part("source"), part("lang"), text("n_chars")])
    node = lambda k, source: f"""l{k} AS MATERIALIZED (SELECT *,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM ({source}))"""  # noqa: E731
    up = lambda k: f"""SELECT g, pos // 8 AS pos, (n + 7) // 8 AS n,
    CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM l{k} GROUP BY g, n, pos // 8"""  # noqa: E731
    total = levels + group_levels
    tables = [node(0, "SELECT g, pos, n, h FROM placed")] + [node(k, up(k - 1)) for k in range(1, levels)]
    tables.append(f"subroots AS MATERIALIZED (SELECT g AS name, h FROM ({up(levels - 1)}))")
    tables.append(node(levels, "SELECT '' AS g, row_number() OVER (ORDER BY name) - 1 AS pos, count(*) OVER () AS n, h FROM subroots"))
    tables += [node(k, up(k - 1)) for k in range(levels + 1, total)]
    tables.append(f"root AS (SELECT h FROM ({up(total - 1)}))")
    joins = "\n".join(f"JOIN l{k} ON l{k}.g = p.g AND l{k}.pos = p.pos // {8 ** k}" for k in range(levels))
    joins += "\nJOIN (SELECT name, h, row_number() OVER (ORDER BY name) - 1 AS pos FROM subroots) s ON s.name = p.g\n"
    joins += "\n".join(f"JOIN l{levels + k} ON l{levels + k}.pos = s.pos // {8 ** k}" for k in range(group_levels))
    proof = " || ".join(f"l{k}.l || l{k}.r" for k in range(total))
    sides = ", ".join(f"l{k}.l AS left{k}, l{k}.r AS right{k}, l{k}.n AS n{k}" for k in range(total))
    folds = ",\n".join(
        f"f{k + 1} AS (SELECT * EXCLUDE (f), CASE WHEN n{k} > 1 THEN sha256(left{k} || f || right{k}) ELSE f END AS f FROM f{k})"
        for k in range(total))
    steps = ["t0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS c FROM range(256))"]
    steps += [f"t{k + 1} AS (SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) AS c FROM t{k})" for k in range(8)]
    return f"""
WITH RECURSIVE {', '.join(steps)},
ids AS (SELECT DISTINCT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS s FROM documents),
crc AS (SELECT doc_id, s, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM ids
  UNION ALL SELECT doc_id, s, k + 1, xor(crc.c >> 8, t8.c) FROM crc JOIN t8 ON t8.i = xor(crc.c, ascii(substr(s, k + 1, 1))) & 255
  WHERE k < len(s)),
bad AS (SELECT doc_id FROM crc WHERE k = len(s) AND xor(c, 4294967295) % 3 = 0),
leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({head} || {part('text')}) AS h,
  CASE WHEN EXISTS (SELECT 1 FROM bad WHERE bad.doc_id IS NOT DISTINCT FROM documents.doc_id)
  THEN sha256({head} || {part(f"translate(text, '{_UPPER}', '{_LOWER}')")}) END AS other FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
  count(*) OVER (PARTITION BY g) AS n FROM leaves),
{(',' + chr(10)).join(tables)},
f0 AS MATERIALIZED (SELECT p.doc_id, p.h AS leaf, s.h AS subroot, sha256({proof}) AS proof_sha256, {sides},
  coalesce(p.other, p.h) AS f FROM placed p
{joins}),
{folds}
SELECT doc_id, leaf, subroot, root.h AS root, proof_sha256, f AS folded_root, f = root.h AS verified FROM f{total}, root"""
