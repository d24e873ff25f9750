"""Prefix trie of conversations: what sharing the common starts of conversations would save.

A node is a distinct sequence of the first d turns of rebuilt conversations; its members are
the conversations that start so. Paths are told by two 64-bit words: the running xor of each
turn's hash with its depth, so texts never shuffle.

1. Turns get their places and paths by windows over each conversation, which stream it in order.
2. One group-by of paths gives each node its smallest member, its owner. What a conversation
   owns is a suffix of its path: from the first node on that no smaller one reaches. So
   ownership is one number a conversation, and a node that all of them share is never joined.
3. Windows over each conversation, last turn first, sum up the tokens of turns that it does not own.
4. One group-by of paths adds these up: over a node's members, the tokens of all occurrences
   below it less those of owned nodes are the saving of its subtree; members that own a
   childless node count its leaves; members that own the next node count its children.
5. The ids that end in a node are dealt to tasks by ranges of (node, id), packed into strings
   there, and a node's strings are hashed in order as they pass, so a node in which a third of
   all conversations end is one task's strings, never its ids or its memory.

Rebuilding (``rebuilt``): a conversation starts with the first h turns of the one with the next
lower multiple of 100, h from a CRC of its id, and goes on with its own turns behind its first h.

Edge cases: a null role or text is empty; turns are ordered by turn, null first, and equal
ones by the hashes of their role and text; rows without a conv_id are left out; repeated rows
are turns each; a conversation left without a turn is a member of the root, and ends in it;
extra columns are ignored; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.runtime import cut

#: Fixed values of the rebuilding: conversations of so many ids share a first one, and at most SHARED - 1 of its turns.
FAMILY, SHARED = 100, 6
NODE = ["depth", "p", "q"]
_PIECE = 1 << 16


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, tokens): each turn's place from 1, two hashes of its role and text, and code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    word = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("long")
    own = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.char_length(text).cast("long").alias("tokens"))
    own = own.select("conv_id", "turn", word(1).alias("a"), word(17).alias("b"), "tokens")
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return own.withColumn("pos", F.row_number().over(w)).select("conv_id", "pos", "a", "b", "tokens")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, part, pos, a, b, tokens): a row for each conversation's root (part 0), borrowed turns (1), own turns (2)."""
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED
    convs = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), h.alias("h"))
    none = F.lit(0).cast("long")
    roots = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("pos"), none.alias("a"), none.alias("b"), none.alias("tokens"))
    first = turns.where(F.col("pos") < SHARED).withColumnRenamed("conv_id", "base")
    lent = convs.join(first, "base").where("pos <= h").select("conv_id", F.lit(1).alias("part"), "pos", "a", "b", "tokens")
    own = turns.where(F.col("pos") > h).select("conv_id", F.lit(2).alias("part"), "pos", "a", "b", "tokens")
    return roots.unionByName(lent).unionByName(own)


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, p, q, p_up, q_up, tokens, goes_on) of rows in the order (part, pos)."""
    w = Window.partitionBy("conv_id").orderBy("part", "pos")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("depth", F.row_number().over(w) - 1)
    salted = lambda *c: F.when(F.col("depth") > 0, F.xxhash64(*c, "depth")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumns({"a": salted("a", "b"), "b": salted(F.lit("second"), "b", "a")})
    rows = rows.withColumns({"p": F.bit_xor("a").over(upto), "q": F.bit_xor("b").over(upto), "goes_on": F.lead("depth").over(w).isNotNull()})
    return rows.select("conv_id", "depth", "p", "q", F.col("p").bitwiseXOR(F.col("a")).alias("p_up"), F.col("q").bitwiseXOR(F.col("b")).alias("q_up"), "tokens", "goes_on")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, p, q, ends_sha256): SHA-256 of the conv_ids, rising and comma-joined, that end in each node; ends: (depth, p, q, conv_id)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, 0, [], 0
        for b in batches:
            out = []
            for *key, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if key != node or size > _PIECE:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids, size = key, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield _rows(out, (*NODE, "first", "ids"))
        if ids:
            yield _rows([(*node, first, ",".join(ids))], (*NODE, "first", "ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for b in batches:
            out = []
            for *key, _, ids in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if key != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(out, (*NODE, "ends_sha256"))
        if node is not None:
            yield _rows([(*node, digest.hexdigest())], (*NODE, "ends_sha256"))

    key = "depth int, p long, q long"
    pieces = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(packed, f"{key}, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{key}, ends_sha256 string")


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"depth": pa.int32(), "p": pa.int64(), "q": pa.int64(), "first": pa.int64()}
    return pa.record_batch([pa.array([r[i] for r in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names=list(names))


def trie(rows: DataFrame) -> DataFrame:
    """A row per node of the trie of ``rows`` (conv_id, part, pos, a, b, tokens), each conversation with one of part 0, its root.

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    on = cut(paths(rows))
    nodes = cut(on.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.max("goes_on").alias("inner")))
    owns = cut(nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("depth").alias("first_owned"), F.max(~F.col("inner")).alias("leaf")))
    marked = on.join(owns.hint("merge"), "conv_id", "left")
    others = F.when(F.col("first_owned").isNull() | (F.col("depth") < F.col("first_owned")), F.col("tokens")).otherwise(0)
    last_first = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("saved", F.sum(others).over(last_first))
    child = F.coalesce(F.col("goes_on") & (F.col("depth") + 1 >= F.col("first_owned")), F.lit(False))
    per = marked.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("p_up").alias("p_up"),
        F.min("q_up").alias("q_up"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if(child).alias("n_children"),
        F.count_if(F.coalesce("leaf", F.lit(False))).alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    per = per.join(ends_digests(on.where("NOT goes_on")).hint("merge"), NODE, "left")
    above = nodes.select((F.col("depth") + 1).alias("below"), F.col("p").alias("p_up"), F.col("q").alias("q_up"), F.col("owner").alias("parent_conv_id"))
    per = per.join(above.hint("merge"), (F.col("depth") == F.col("below")) & (per["p_up"] == above["p_up"]) & (per["q_up"] == above["q_up"]), "left")
    return per.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    return trie(rebuilt(cut(turns_in_order(table(spark, sf_dir, "conversations")))))


_CRC = "xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"

ORACLE = f"""
    WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS v, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, CAST({_CRC} % {SHARED} AS BIGINT) AS h FROM (SELECT DISTINCT conv_id FROM t)),
    r AS (SELECT c.conv_id, 1 AS part, pos, v FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
          UNION ALL SELECT c.conv_id, 2, pos, v FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
    s AS (SELECT c.conv_id, coalesce(x, []) AS x FROM c LEFT JOIN (SELECT conv_id, list(v ORDER BY part, pos) AS x FROM r GROUP BY conv_id) USING (conv_id)),
    e AS (SELECT conv_id, d, x[1:d] AS k, len(x) = d AS ends FROM (SELECT conv_id, x, unnest(range(0, len(x) + 1)) AS d FROM s)),
    n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN length(k[d].t) ELSE 0 END AS tokens, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM e GROUP BY k, d),
    a AS (SELECT n.k, n.d, count(m.k) AS n_children FROM n LEFT JOIN n m ON m.d = n.d + 1 AND m.k[1:n.d] = n.k GROUP BY n.k, n.d),
    u AS (SELECT k[1:i] AS k, i AS d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * tokens) AS BIGINT) AS saved FROM (SELECT n.*, n_children, unnest(range(0, n.d + 1)) AS i FROM n JOIN a ON a.d = n.d AND a.k = n.k) GROUP BY ALL)
    SELECT n.conv_id, n.d AS depth, o.conv_id AS parent_conv_id, n.n_convs, a.n_children, u.n_leaves, u.saved AS saved_tokens, n.ends_sha256
    FROM n JOIN a ON a.d = n.d AND a.k = n.k JOIN u ON u.d = n.d AND u.k = n.k LEFT JOIN n o ON o.d = n.d - 1 AND o.k = n.k[1:n.d - 1]
"""
