"""Prefix trie of conversations by burst tries.

A conversation is its path, a string of fixed-width turn ids. Containers hold the rest of
paths under a head, the trie node that all of them pass. A container with too many turns
bursts: one of its paths is chosen by hash, the nodes along it become trie nodes, and at
each of them the other paths go to new containers by their next turn id. What fits is
sorted and swept into nodes inside one task. Sums of subtrees then climb from the
containers through the burst paths, the last round first.

Bursting along a whole path instead of one turn a round keeps the number of rounds
logarithmic, however long the prefixes are that conversations share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map, arrow_stream, discard, stage
from meseta.llm.registry import query, table

WIDTH = 24
"""Bytes of a turn id: 128 bits of a digest, then the UTF-8 length of the text in 8 bytes."""
NO_MEMBERS = hashlib.sha256().hexdigest()
_ROOT = hashlib.sha256(b"root").digest()
_BUCKET = 1 << 16
_NODES = 20_000  # rows of an output batch


def turn_id(role: str, text: str) -> Column:
    """Hex id of a turn: equal for equal role and text, and it tells the length of the text."""
    role_, text_ = F.col(role), F.col(text)
    digest = F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, F.lit(":"), text_), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text_).cast("long")), 16, "0"))


def paths(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, path) of every conversation: its turns by number (null first), role, then text.

    Null roles and texts are empty; rows without a conversation id belong to none and are
    left out. A path holds 24 bytes a turn, and one conversation's path is one row.
    """
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), "turn",
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("role", "text")])
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    ids = rows.select("conv", F.row_number().over(order).alias("at"), turn_id("role", "text").alias("id"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", "id"))), lambda turn: turn["id"])
    return ids.groupBy("conv").agg(F.unhex(F.array_join(in_order, "")).alias("path"))


def member_digests(members: DataFrame) -> DataFrame:
    """(seq, ends) from (seq, conv): SHA-256 of the decimal conv ids, ascending, comma-joined.

    A digest is sequential, so one task hashes one group, but it reads texts of up to
    65,536 ids each, which other tasks have sorted and joined, and holds none of them.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda conv: conv.cast("string"))
    texts = members.groupBy("seq", F.floor(F.col("conv") / F.lit(_BUCKET)).alias("bucket")).agg(
        F.array_join(ids, ",").alias("ids"))
    rows = texts.repartition("seq").sortWithinPartitions("seq", "bucket")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, state, done = None, None, []
        for batch in batches:
            for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
                if seq == now:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((now, state.hexdigest()))
                now, state = seq, hashlib.sha256(ids.encode())
            if len(done) > _NODES:
                yield dict(zip(("seq", "ends"), zip(*done)))
                done = []
        if state:
            done.append((now, state.hexdigest()))
            yield dict(zip(("seq", "ends"), zip(*done)))

    return arrow_stream(rows.select("seq", "ids"), digest, "seq binary, ends string")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from their start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:  # longest equal prefix, by halving
        middle = (low + high + 1) // 2
        if a[low * WIDTH:middle * WIDTH] == b[low * WIDTH:middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def text_bytes(turn: bytes) -> int:
    return int.from_bytes(turn[16:WIDTH], "big")


# A row of a container: rest of the path below the head, members with this path, the
# smallest of them, their digest; the head's depth, text bytes, and the node above it.
_ROW = ("head binary, up binary, round int, depth long, top_bytes long, rest binary, n long, least long, ends string")


def _burst(rows: DataFrame, number: int) -> DataFrame:
    """Rows of oversized containers with their place on the path of the head (column pivot).

    ``at`` counts the turns shared with it. The other columns are those of the new
    container, whose head is the next turn; a row that ends on the path has none.
    """

    def split(batch: pa.RecordBatch) -> Iterator[dict]:
        at, heads, rests, sizes = [], [], [], []
        for head, rest, pivot in zip(*(batch.column(c).to_pylist() for c in ("head", "rest", "pivot"))):
            shared = common_turns(rest, pivot)
            turn = rest[shared * WIDTH:(shared + 1) * WIDTH]
            at.append(shared)
            heads.append(hashlib.sha256(head + shared.to_bytes(8, "big") + turn).digest() if turn else None)
            rests.append(rest[(shared + 1) * WIDTH:])
            sizes.append(text_bytes(turn) if turn else 0)
        depths = [depth + shared + 1 for depth, shared in zip(batch.column("depth").to_pylist(), at)]
        yield {
            "old": batch.column("head"), "at": at, "head": heads,
            "up": [old + shared.to_bytes(8, "big") for old, shared in zip(batch.column("head").to_pylist(), at)],
            "round": [number] * len(at), "depth": depths, "top_bytes": sizes, "rest": rests,
            "n": batch.column("n"), "least": batch.column("least"), "ends": batch.column("ends")}

    return arrow_map(rows, split, "old binary, at long, " + _ROW)


def _path_nodes(oversized: DataFrame, placed: DataFrame) -> DataFrame:
    """Nodes along the path of each burst head, without what hangs below the path."""
    levels = placed.groupBy(F.col("old").alias("head"), "at").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"),
        F.max(F.when(placed["head"].isNull(), F.col("ends"))).alias("ends"))
    turns = (F.length("pivot") / WIDTH).cast("long")
    line = oversized.select("*", turns.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), turns)).alias("at"))
    upward = Window.partitionBy("head").orderBy(F.desc("at"))
    size = F.conv(F.hex(F.substring("pivot", (F.col("at") - 1) * WIDTH + 17, F.lit(8))), 16, 10).cast("long")
    node = F.concat("head", F.unhex(F.lpad(F.hex("at"), 16, "0")))
    above = F.concat("head", F.unhex(F.lpad(F.hex(F.col("at") - 1), 16, "0")))
    return line.join(levels, ["head", "at"], "left").select(
        "head", "at", "round", (F.col("depth") + F.col("at")).alias("depth"), (F.col("at") < F.col("last")).alias("inner"),
        node.alias("node"), F.when(F.col("at") == 0, F.col("up")).otherwise(above).alias("up"),
        F.when(F.col("at") == 0, F.col("top_bytes")).otherwise(size).alias("bytes"),
        F.sum("n").over(upward).alias("n_convs"), F.min("least").over(upward).alias("conv_id"),
        F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"))


_SWEPT = ("up binary, round int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string")


class _Container:
    """Nodes of one container, from its rows in order; node 0 is the head."""

    def __init__(self, up: bytes | None, number: int | None, depth: int, size: int):
        self.up, self.round, self.depth = up, number, depth
        self.parent, self.size, self.level = [-1], [size], [depth]
        self.count, self.least, self.ends = [0], [None], [NO_MEMBERS]
        self._stack, self._before = [0], b""

    def add(self, rest: bytes, n: int, least: int, ends: str) -> None:
        shared = common_turns(rest, self._before)
        del self._stack[shared + 1:]
        for at in range(shared, len(rest) // WIDTH):
            self.parent.append(self._stack[-1])
            self._stack.append(len(self.size))
            self.size.append(text_bytes(rest[at * WIDTH:(at + 1) * WIDTH]))
            self.level.append(self.depth + at + 1)
            self.count.append(0)
            self.least.append(None)
            self.ends.append(NO_MEMBERS)
        node = self._stack[-1]
        self.count[node] += n
        self.least[node], self.ends[node] = least, ends
        self._before = rest

    def nodes(self) -> dict[str, list]:
        total = len(self.size)
        children, leaves, saved = [0] * total, [0] * total, [0] * total
        for node in range(total - 1, -1, -1):  # children come after their parents
            leaves[node] = leaves[node] or 1
            saved[node] += (self.count[node] - 1) * self.size[node]
            above = self.parent[node]
            if above >= 0:
                self.count[above] += self.count[node]
                mine, theirs = self.least[node], self.least[above]
                self.least[above] = mine if theirs is None else min(mine, theirs)
                children[above] += 1
                leaves[above] += leaves[node]
                saved[above] += saved[node]
        return {
            "up": [self.up] + [None] * (total - 1), "round": [self.round] + [None] * (total - 1),
            "conv_id": self.least, "depth": self.level,
            "parent_conv_id": [None] + [self.least[above] for above in self.parent[1:]], "n_convs": self.count,
            "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": self.ends}


def _sweep(containers: DataFrame) -> DataFrame:
    """Nodes of all containers; the head of a container has ``up``, unless it is the root."""
    rows = containers.repartition("head").sortWithinPartitions("head", "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, container, done = None, None, []
        for batch in batches:
            for head, up, number, depth, size, rest, n, least, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if head != now:
                    if container:
                        done.append(container.nodes())
                    if sum(len(part["depth"]) for part in done[-1:]) > _NODES or len(done) > 2_000:
                        yield _joined(done)
                        done = []
                    now, container = head, _Container(up, number, depth, size)
                container.add(rest, n, least, ends)
        if container:
            yield _joined([*done, container.nodes()])

    return arrow_stream(rows, run, _SWEPT)


def _joined(parts: list[dict]) -> dict:
    return {name: [value for part in parts for value in part[name]] for name in parts[0]}


def prefix_trie(paths: DataFrame, *, container_turns: int = 1 << 16) -> DataFrame:
    """Nodes of the trie over (conv, path) rows, each conv once.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 per distinct prefix; conv_id and depth name a node. The
    root is a node unless there are no conversations at all. Equal paths are counted
    before anything else, so copies of a conversation are one row afterwards. Containers
    over ``container_turns`` burst until none is left.
    """
    keyed = paths.select("conv", "path", F.unhex(F.sha2("path", 256)).alias("seq"))
    distinct = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("conv").alias("least"))
    ends = member_digests(keyed.select("seq", "conv"))
    current = stage(
        distinct.withColumn("seq", F.unhex(F.sha2("path", 256))).join(ends, "seq").select(
            F.lit(_ROOT).alias("head"), F.lit(None).cast("binary").alias("up"), F.lit(None).cast("int").alias("round"),
            F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("top_bytes"), F.col("path").alias("rest"),
            "n", "least", "ends"), "containers")
    fitting, lines, used = [], [], [current]
    while True:
        load = current.groupBy("head").agg(F.sum(F.length("rest") / WIDTH + 1).alias("load"))
        big = stage(load.where(F.col("load") > container_turns).select("head"), "oversized")
        used.append(big)
        if big.isEmpty():
            fitting.append(current)
            break
        fitting.append(current.join(big, "head", "left_anti").select(*current.columns))
        bursting = current.join(big, "head")
        number = len(lines)
        oversized = stage(bursting.groupBy("head").agg(
            F.min_by("rest", F.xxhash64("head", "rest")).alias("pivot"), F.first("up").alias("up"),
            F.first("round").alias("above"), F.first("depth").alias("depth"), F.first("top_bytes").alias("top_bytes"),
        ).withColumn("round", F.lit(number)), "burst-paths")
        placed = stage(_burst(bursting.join(oversized.select("head", "pivot"), "head"), number), "burst")
        lines.append(stage(_path_nodes(oversized, placed), "path-nodes"))
        used += [oversized, placed, lines[-1]]
        current = placed.where(F.col("head").isNotNull()).drop("old", "at")
    containers = fitting[0]
    for part in fitting[1:]:
        containers = containers.unionByName(part)
    swept = stage(_sweep(containers), "swept")
    tops = swept.where(F.col("up").isNotNull())
    hanging = tops.select("up", "n_leaves", "saved_tokens")
    nodes = [swept.where(F.col("up").isNull())]
    if lines:
        keys = lines[0].select(F.col("node").alias("up"), F.col("conv_id").alias("parent"))
        for line in lines[1:]:
            keys = keys.unionByName(line.select(F.col("node").alias("up"), F.col("conv_id").alias("parent")))
    for line in reversed(lines):
        below = hanging.groupBy(F.col("up").alias("node")).agg(
            F.count("*").alias("others"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        upward = Window.partitionBy("head").orderBy(F.desc("at"))
        known = line.join(below, "node", "left").na.fill(0, ["others", "leaves", "saved"])
        leaf = F.when(~F.col("inner") & (F.col("others") == 0), 1).otherwise(0)
        whole = stage(known.select(
            "head", "at", "up", "conv_id", "depth", "n_convs", "ends_sha256",
            (F.col("others") + F.col("inner").cast("long")).alias("n_children"),
            F.sum(F.col("leaves") + leaf).over(upward).alias("n_leaves"),
            F.sum(F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).over(upward).alias("saved_tokens")), "summed")
        used.append(whole)
        nodes.append(whole)
        tops = tops.unionByName(whole.where("at = 0"), allowMissingColumns=True)
        hanging = hanging.unionByName(whole.where("at = 0").select("up", "n_leaves", "saved_tokens"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = nodes[0].select(*columns)
    if lines:
        hung = swept.where(F.col("up").isNotNull()).drop("parent_conv_id", "round")
        for line in nodes[1:]:
            hung = hung.unionByName(line.drop("head", "at"))
        out = out.unionByName(hung.join(keys, "up", "left").withColumnRenamed("parent", "parent_conv_id").select(*columns))
    return out


def shared_openings(own: DataFrame, family: int = 5, choices: int = 9) -> DataFrame:
    """(conv, path) where the first crc32(conv) % 9 turns are those of conversation conv - conv % 5.

    Shorter openings are taken whole, and none where that conversation is absent.
    """
    wide = choices * WIDTH
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(choices))
    openings = own.select(F.col("conv").alias("base"), F.substring("path", 1, wide).alias("opening"))
    rows = own.withColumn("base", F.col("conv") - F.col("conv") % family).withColumn("taken", (h * WIDTH).cast("int"))
    start = F.coalesce(F.substring(F.col("opening"), F.lit(1), F.col("taken")), F.lit(b""))
    rest = F.substring(F.col("path"), F.col("taken") + 1, F.length("path"))
    return rows.join(openings, "base", "left").select("conv", F.concat(start, rest).alias("path"))


# crc32 of the decimal id, a bit at a time; 3988292384 is the reversed polynomial
_CRC = ("xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT)), "
        "lambda s, d: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(s, d)), "
        "CAST(4294967295 AS BIGINT)), 4294967295)")


@query("op11_prefix_trie", sql=f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT c, c - c % 5 AS b, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT i.c, t.k, role, text FROM i JOIN t ON t.c = i.b AND t.k <= i.h
  UNION ALL SELECT i.c, t.k, role, text FROM i JOIN t ON t.c = i.c AND t.k > i.h),
q AS (SELECT i.c, coalesce(list(sha256(length(role) || ':' || role || ':' || text) ORDER BY k) FILTER (k IS NOT NULL), []) AS p,
    coalesce(list(octet_length(encode(text)) ORDER BY k) FILTER (k IS NOT NULL), []) AS s
  FROM i LEFT JOIN r USING (c) GROUP BY i.c),
m AS (SELECT c, d, list_slice(p, 1, d) AS p, len(p) = d AS ended, CASE WHEN d = 0 THEN 0 ELSE s[d] END AS size
  FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM q)),
n AS (SELECT min(c) AS conv_id, d AS depth, p, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
  FROM m GROUP BY d, p),
f AS (SELECT n.*, list_slice(p, 1, depth - 1) AS above, coalesce(k.kids, 0) AS kids FROM n
  LEFT JOIN (SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS kids FROM n WHERE depth > 0 GROUP BY 1) k USING (p)),
u AS (SELECT a.p, count(*) FILTER (b.kids = 0) AS leaves, sum(b.saved) AS saved
  FROM f a JOIN f b ON b.depth >= a.depth AND list_slice(b.p, 1, a.depth) = a.p GROUP BY a.p)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.kids AS n_children, u.leaves AS n_leaves,
  CAST(u.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN u USING (p) LEFT JOIN f up ON f.depth > 0 AND up.p = f.above""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = stage(paths(table(spark, folder, "conversations")), "paths")
    rebuilt = stage(shared_openings(own), "rebuilt-paths")
    discard(own)
    return prefix_trie(rebuilt)
