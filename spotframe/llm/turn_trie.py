"""Prefix trie of conversations whose openings come from other conversations, by composable fingerprints.

A fingerprint is a pair (n, f) for a sequence of n turns, with f the sum of value(turn) * base**place modulo a
prime. Fingerprints compose: (n, f) then (m, g) is (n + m, f + base**n * g), with the empty sequence as
neutral element, and as bases have inverses a run cut out of a sequence has one too. The fingerprint of a
rebuilt conversation is therefore put together from the running ones of the two stored conversations; rebuilt
texts are never made. Three primes side by side make one fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spotframe.llm.common import SQL_CRC_STEPS, WORD, crc_mod, numbered, running_sums, save, sql_crc, text_or_empty

#: Three primes below 2**31: products of two residues fit a long.
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = ("x", "y", "z")


def _powers(base: int, prime: int, places: np.ndarray) -> np.ndarray:
    out, square, left = np.ones(len(places), np.uint64), base % prime, places.astype(np.uint64)
    while left.any():
        out = np.where(left & 1, out * np.uint64(square) % np.uint64(prime), out)
        square, left = square * square % prime, left >> np.uint64(1)
    return out


def _bases(attempt: int) -> list[int]:
    """Bases of an attempt: fixed numbers, so that reruns agree."""
    return [int.from_bytes(hashlib.sha256(f"turns:{attempt}:{p}".encode()).digest()[:8], "big") % (p - 3) + 2 for p in PRIMES]


def turn_references(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, k, n, ref, words), stored: places k = 1 .. n of each conversation's turns; ref is equal just where role and text are.

    References are 128-bit digests. They are verified by grouping on the digest and on the role and text
    themselves (equal turns meet before the shuffle); a digest shared by different turns raises.
    """
    role, text = text_or_empty(F.col(role_col)), text_or_empty(F.col(text_col))
    said = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("t"), role.alias("role"), text.alias("text"))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    known = said.withColumn("ref", digest)
    alike = known.groupBy("ref", "role", "text").agg(F.count(F.lit(1)).alias("n")).groupBy("ref").agg(F.count(F.lit(1)).alias("kinds"))
    if not alike.where("kinds > 1").isEmpty():
        raise ValueError("different turns share a digest")
    light = save(known.select("c", "t", "ref", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")))
    placed = numbered(light, [F.col("c"), F.col("t").asc_nulls_first(), F.col("ref")], "g")
    ends = placed.groupBy("c").agg(F.min("g").alias("g0"), F.count(F.lit(1)).alias("n"))
    return save(placed.join(ends, "c").select("c", (F.col("g") - F.col("g0") + 1).alias("k"), "n", "ref", "words"))


def running_fingerprints(turns: DataFrame, attempt: int) -> DataFrame:
    """turns (c, k, ref ...) with x, y, z: the fingerprint of the conversation's first k turns."""
    bases = _bases(attempt)

    @F.pandas_udf("struct<x long, y long, z long>")
    def powers(place: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({lane: _powers(b, p, place.to_numpy()).astype(np.int64) for lane, b, p in zip(LANES, bases, PRIMES)})

    value = lambda i: F.conv(F.substring("ref", 1 + 8 * i, 8), 16, 10).cast("long") % PRIMES[i]
    terms = turns.withColumn("_p", powers("k")).select(*turns.columns, *[(value(i) * F.col(f"_p.{lane}") % PRIMES[i]).alias(lane) for i, lane in enumerate(LANES)])
    summed = running_sums(terms, "c", "k", list(LANES))
    return summed.select(*turns.columns, *[(F.col(lane) % p).alias(lane) for lane, p in zip(LANES, PRIMES)])


def rebuilt_paths(turns: DataFrame, attempt: int, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(paths, convs), stored.

    paths (c, d, x, y, z, ref, words, len): for each place d of a rebuilt conversation the fingerprint of its first d
    turns and its d-th turn as a reference; convs (c, len): all conversations, those without turns included.
    """
    own = save(running_fingerprints(turns, attempt))
    # the first turns of a conversation, at most most - 1 of them: all that a base gives away
    firsts = own.where(F.col("k") < most).groupBy("c").agg(F.array_sort(F.collect_list(F.struct("k", *LANES, "ref", "words"))).alias("first"))
    convs = own.groupBy("c").agg(F.max("n").alias("n")).join(firsts, "c")
    base = F.col("c") - F.col("c") % group
    asked = convs.withColumn("b", base).withColumn("h", F.when(F.col("b") == F.col("c"), F.lit(0)).otherwise(crc_mod(F.col("c"), most)).cast("int"))
    given = convs.select(F.col("c").alias("b"), F.col("first").alias("head"))
    # head: what the base gives, fewer than asked where it is short or absent; cut: the own turns left out
    joined = asked.join(given, "b", "left").withColumn("head", F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast(given.schema["head"].dataType)))
    head, cut = F.size("head"), F.least(F.col("h").cast("long"), F.col("n"))
    last = lambda array, at: [F.coalesce(F.get(array, at - 1)[lane], F.lit(0).cast("long")) for lane in LANES]
    plan = joined.select(
        "c", "h", "head", head.cast("long").alias("hn"), (head + F.col("n") - cut).alias("len"),
        F.struct(*[v.alias(lane) for v, lane in zip(last(F.col("head"), head), LANES)]).alias("front"),
        F.struct(*[v.alias(lane) for v, lane in zip(last(F.col("first"), cut.cast("int")), LANES)]).alias("left_out"),
    )
    plan = save(plan)
    heads = plan.select("c", "len", F.explode("head").alias("t")).select("c", F.col("t.k").alias("d"), *[F.col(f"t.{lane}").alias(lane) for lane in LANES], "t.ref", "t.words", "len")
    # the own turns after the first h: their product is the running one without the part left out, moved to
    # the place where the head ends, which is at most most - 1 places earlier than its own
    moves = [F.array(*[F.lit(pow(pow(b, -1, p), i, p)) for i in range(most)]) for b, p in zip(_bases(attempt), PRIMES)]
    tail = own.join(plan.select("c", "h", "hn", "len", "front", "left_out"), "c").where(F.col("k") > F.col("h"))
    back = (F.col("h") - F.col("hn")).cast("int")
    composed = [
        F.pmod(F.col(f"front.{lane}") + F.pmod(F.col(lane) - F.col(f"left_out.{lane}"), F.lit(p)) * F.get(move, back), F.lit(p)).alias(lane)
        for lane, p, move in zip(LANES, PRIMES, moves)
    ]
    tails = tail.select("c", (F.col("hn") + F.col("k") - F.col("h")).alias("d"), *composed, "ref", "words", "len")
    return save(heads.unionByName(tails)), save(plan.select("c", "len"))


def _ends(convs: DataFrame) -> DataFrame:
    """(owner, d, ends_sha256) from (owner, d, c): digest of the ids c, ascending, joined by commas.

    Ids are sorted in ranges of the whole table and written out in chunks of up to 4096; a task then
    streams through the chunks of a node, so that it never holds the list, however many ids end at one node.
    """
    placed = numbered(convs, [F.col("owner"), F.col("d"), F.col("c")], "g")
    chunks = placed.groupBy("owner", "d", F.floor(F.col("g") / 4096).alias("chunk")).agg(F.sort_array(F.collect_list("c")).alias("ids"))
    written = chunks.select("owner", "d", "chunk", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        for batch in batches:
            for owner, d, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (owner, d) != node:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (owner, d), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("owner", "d", "ends_sha256"), o)) for o in out], ENDS)
            out = []
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("owner", "d", "ends_sha256"), (*node, sha.hexdigest())))], ENDS)

    return written.repartition("owner", "d").sortWithinPartitions("owner", "d", "chunk").mapInArrow(digest, "owner long, d long, ends_sha256 string")


ENDS = pa.schema([("owner", pa.int64()), ("d", pa.int64()), ("ends_sha256", pa.string())])


def conversation_trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    group: int = 20,
    most: int = 4,
    attempts: int = 4,
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per node.

    Conversation c is rebuilt from the first h turns of conversation c - c % group (% keeps the sign of c) and
    its own turns after the first h, h = crc32(c in decimal) % most. A node is a distinct sequence of first turns
    and is named by its smallest member and its depth: a conversation is the smallest member of the
    nodes from some depth on to its end, so what a subtree adds up to is what its members own there, and
    sums over subtrees are sums over members instead of rounds up the trie.

    Turns meet by depth and fingerprint. That is verified, not believed: all members of a group must refer to
    the same last turn. As the fingerprint less the last turn's part is that of the parent, this proves
    level by level that the sequences are equal; a group that fails is a collision and all is repeated with
    other bases.

    Defined cases: turns without a conv_id belong to no conversation; a null turn comes first, and turns that
    share their number follow each other in order of the digest of role and text, so reruns agree; null role
    and text are empty; rows that repeat a turn are turns of their own; a conversation that is left without turns is a
    member of the root only; an empty table has no root and gives no rows; other columns are ignored.
    """
    stored = turn_references(turns, conv_col, turn_col, role_col, text_col)
    for attempt in range(attempts):
        paths, convs = rebuilt_paths(stored, attempt, group, most)
        nodes = paths.groupBy("d", *LANES).agg(
            F.min("c").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("len").alias("longest"), F.max("words").alias("w"),
            F.min("ref").alias("one"), F.max("ref").alias("other"),
        )
        nodes = save(nodes)
        if nodes.where(F.col("one") != F.col("other")).isEmpty():
            break
    else:
        raise RuntimeError("fingerprints of different sequences met in every attempt")
    gain = ((F.col("n_convs") - 1) * F.col("w")).alias("v")
    members = save(paths.select("c", "d", *LANES, "len").join(nodes.select("d", *LANES, "owner", "n_convs", "longest", gain), ["d", *LANES]).drop(*LANES))

    # what each conversation owns: the nodes below `joins`, where it leaves the path of the node (owned by `at`) above
    mine = F.col("owner") == F.col("c")
    owns = members.groupBy("c").agg(
        F.coalesce(F.max(F.when(~mine, F.col("d"))), F.lit(0)).alias("joins"),
        F.max_by(F.when(~mine, F.col("owner")), F.when(~mine, F.col("d"))).alias("at"),
        F.coalesce(F.sum(F.when(mine, F.col("v"))), F.lit(0)).alias("total"),
        F.max(F.when(mine & (F.col("d") == F.col("len")) & (F.col("longest") == F.col("len")), 1).otherwise(0)).alias("leaf"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    convs = save(convs.join(owns, "c", "left").select("c", "len", zero("joins"), "at", zero("total"), zero("leaf")))
    root = convs.agg(
        F.min("c").alias("c"), F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"), F.sum("leaf").alias("leaves"),
        F.count(F.when((F.col("len") > 0) & (F.col("joins") == 0), 1)).alias("children"),
    ).first()
    first = F.lit(root["c"]).cast("long")

    below = members.select("c", "owner", "d").join(convs.select("c", "total", "leaf"), "c").groupBy("owner", "d").agg(F.sum("total").alias("total"), F.sum("leaf").alias("n_leaves"))
    branches = convs.where((F.col("joins") > 0) & (F.col("len") > F.col("joins"))).groupBy(F.col("at").alias("owner"), F.col("joins").alias("d")).agg(F.count(F.lit(1)).alias("branches"))
    ending = members.where(F.col("d") == F.col("len")).select("owner", "d", "c").union(convs.where("len = 0").select(first.alias("owner"), F.lit(0).cast("long").alias("d"), "c"))
    ends = save(_ends(ending))
    owned = running_sums(members.where(mine).select("c", "d", "len", "n_convs", "v", F.col("v").alias("upto")), "c", "d", ["upto"])
    named = owned.withColumnRenamed("c", "owner").join(convs.select(F.col("c").alias("owner"), "joins", "at"), "owner")
    nothing = hashlib.sha256(b"").hexdigest()
    table = (
        named.join(below, ["owner", "d"])
        .join(branches, ["owner", "d"], "left")
        .join(ends, ["owner", "d"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            F.col("d").alias("depth"),
            F.when(F.col("d") > F.col("joins") + 1, F.col("owner")).when(F.col("joins") == 0, first).otherwise(F.col("at")).alias("parent_conv_id"),
            "n_convs",
            (zero("branches") + (F.col("len") > F.col("d")).cast("long")).alias("n_children"),
            "n_leaves",
            (F.col("total") - F.col("upto") + F.col("v")).alias("saved_tokens"),
            F.coalesce(F.col("ends_sha256"), F.lit(nothing)).alias("ends_sha256"),
        )
    )
    if not root["n"]:
        return table
    top = ends.where("d = 0").agg(F.coalesce(F.max("ends_sha256"), F.lit(nothing)).alias("ends_sha256"))
    whole = {"n_convs": root["n"], "n_children": root["children"], "n_leaves": max(root["leaves"], 1), "saved_tokens": root["total"]}
    return table.union(
        top.select(
            first.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            *[F.lit(v).cast("long").alias(k) for k, v in whole.items()], "ends_sha256",
        )
    )


OP13_SQL = f"""
WITH {SQL_CRC_STEPS},
own AS (
  SELECT conv_id AS c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
asked AS (SELECT c, c - c % 20 AS b, turns, CASE WHEN c % 20 = 0 THEN 0 ELSE {sql_crc("id")} % 4 END AS h FROM (SELECT *, CAST(c AS VARCHAR) AS id FROM own), crc_steps),
rebuilt AS (
  SELECT a.c, CASE WHEN h = 0 THEN a.turns ELSE list_concat(CASE WHEN o.turns IS NULL THEN [] ELSE o.turns[1:h] END, a.turns[h + 1:]) END AS turns
  FROM asked a LEFT JOIN own o ON o.c = a.b),
paths AS (SELECT c, d, turns[1:d] AS p, len(turns) AS n FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, max(n) > d AS grows, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d].text, '[^\\x20\\x09-\\x0D]+')) END AS v
  FROM paths GROUP BY d, p),
under AS (
  SELECT a AS d, p[1:a] AS p, sum(v) AS saved_tokens, count(*) FILTER (WHERE NOT grows) AS n_leaves, count(*) FILTER (WHERE d = a + 1) AS n_children
  FROM (SELECT d, p, v, grows, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN under u ON n.d = u.d AND n.p = u.p LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = n.p[1:n.d - 1]
"""
