"""Prefix trie of conversations by block hashing: blocks of turns first, single turns where siblings diverge."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.llm.common import store

BLOCK_TURNS = 4
CHUNK = 4096  # positions, or ids, that are handled together
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def ordered_turns(
    conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, idx, d1, d2, n_chars``: the turns numbered from 0 per conversation, each as a 128-bit digest of role and
    text and the code points of its text.

    Order: turn (null first), then role, then text; rows equal in all of them are separate turns. Null role or text is
    empty; rows without a conversation id are left out. A conversation is numbered in chunks of turn values, so one that
    holds a third of all rows is many tasks.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    rows = conversations.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.where("conv_id IS NOT NULL").withColumns({
        "span": F.floor(F.col("turn") / CHUNK),
        "part": F.when(F.col("turn").isNull(), F.substring(F.concat("role", F.lit("\0"), "text"), 1, 16)).otherwise(""),
    })
    chunk = ["conv_id", "span", "part"]
    sizes = rows.groupBy(*chunk).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("span", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("skip", F.sum("n").over(earlier)).where("skip IS NOT NULL").drop("n")
    inside = F.row_number().over(Window.partitionBy(*chunk).orderBy("turn", "role", "text")) - 1
    numbered = rows.withColumn("at", inside).select(
        *chunk, "at", F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "text", "role").alias("d2"), F.length("text").alias("n_chars")
    )
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in chunk]
    return numbered.alias("a").join(offsets.alias("b"), same, "left").select(
        "a.conv_id", (F.col("at") + F.coalesce("skip", F.lit(0))).alias("idx"), "d1", "d2", F.col("n_chars").cast("bigint").alias("n_chars")
    )


def _digest(turns: str | Column, start: Column, i: int) -> Column:
    return F.aggregate(turns, start, lambda a, t: _xor(a, t[f"e{i}"]))


def _blocks(turns: DataFrame, block_turns: int) -> DataFrame:
    """One row per conversation and block: its turns, its digest, and the digest of all turns before it.

    A prefix is the set of its (position, turn) pairs, so its digest is the exclusive or of their hashes and a running value
    over blocks, taken in chunks of them.
    """
    at = F.struct("idx", F.xxhash64("d1", "d2", "idx").alias("e1"), F.xxhash64(F.lit(1), "d2", "d1", "idx").alias("e2"), "n_chars")
    rows = turns.groupBy("conv_id", F.floor(F.col("idx") / block_turns).alias("k")).agg(F.sort_array(F.collect_list(at)).alias("turns"))
    rows = rows.withColumns({f"h{i}": _digest("turns", F.lit(0).cast("bigint"), i) for i in (1, 2)})
    rows = store(rows.withColumn("chunk", F.floor(F.col("k") / CHUNK)), "blocks")
    chunks = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.withColumns({f"o{i}": F.bit_xor(f"h{i}").over(earlier) for i in (1, 2)}).where("chunk > 0").drop("h1", "h2")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"b{i}": F.coalesce(F.bit_xor(f"h{i}").over(inside), F.lit(0)) for i in (1, 2)})
    joined = rows.join(before, ["conv_id", "chunk"], "left")
    return joined.select(
        "conv_id", "k", "turns", "h1", "h2", *[_xor(F.col(f"b{i}"), F.coalesce(f"o{i}", F.lit(0))).alias(f"b{i}") for i in (1, 2)]
    )


def _turn_rows(blocks: DataFrame, *extra: str) -> DataFrame:
    """Every turn of some blocks: its depth, the digests of the prefix that it ends (p) and of the one before (q)."""
    def prefix(i: int) -> Column:
        return _digest(F.slice("turns", F.lit(1), F.col("j")), F.col(f"b{i}"), i)

    each = blocks.withColumn("j", F.explode(F.sequence(F.lit(1), F.size("turns")))).withColumn("t", F.get("turns", F.col("j") - 1))
    each = each.withColumns({"p1": prefix(1), "p2": prefix(2)})
    return each.select(
        "conv_id", *extra, (F.col("t.idx") + 1).alias("depth"), "p1", "p2", _xor(F.col("p1"), F.col("t.e1")).alias("q1"),
        _xor(F.col("p2"), F.col("t.e2")).alias("q2"), F.col("t.n_chars").alias("n_chars"),
    )


# xxhash64 permutes the 64-bit integers, so ranks are as distinct as ids
_RANK = F.xxhash64
_MEMBERS = ("n_convs", "first_id", "rep")


def _members() -> list[Column]:
    return [F.count("*").alias("n_convs"), F.min("conv_id").alias("first_id"), F.min(_RANK("conv_id")).alias("rep")]


def _nodes(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """``depth, p1, p2, q1, q2, n_chars, n_convs, first_id, rep`` of every node, the root included.

    Conversations that agree up to a block form a group. Where all of them go on with the same block, its turns are nodes
    with the group's members, taken from one of them. Only where they differ are the turns themselves grouped. ``rep`` is
    the least rank of a member: the nodes with one rep form a path downwards.
    """
    later = blocks.where("k > 0")
    n_turns = F.size("turns")
    groups = later.groupBy("k", "b1", "b2").agg(
        *_members(),
        *[f(c).alias(f"{name}_{c}") for c in ("h1", "h2") for f, name in ((F.min, "lo"), (F.max, "hi"))],
        F.min(n_turns).alias("lo_n"), F.max(n_turns).alias("hi_n"),
    )
    agree = (F.col("lo_h1") == F.col("hi_h1")) & (F.col("lo_h2") == F.col("hi_h2")) & (F.col("lo_n") == F.col("hi_n"))
    groups = groups.select("k", "b1", "b2", *_MEMBERS, agree.alias("agree"))
    grouped = later.join(groups, ["k", "b1", "b2"])
    common = _turn_rows(grouped.where(F.col("agree") & (_RANK("conv_id") == F.col("rep"))), *_MEMBERS).drop("conv_id")
    # the first blocks are the root's children, which hardly ever agree
    apart = blocks.where("k = 0").unionByName(grouped.where(~F.col("agree")).select(*blocks.columns))
    found = _turn_rows(apart).groupBy("depth", "p1", "p2").agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("n_chars").alias("n_chars"), *_members()
    )
    zero = {c: F.lit(0).cast("bigint") for c in ("depth", "p1", "p2", "q1", "q2", "n_chars")}
    root = members.agg(*_members()).where("n_convs > 0").withColumns(zero)
    return found.unionByName(common).unionByName(root)


def _from_here(df: DataFrame, by: list[str], position: str, values: list[str]) -> DataFrame:
    """Adds for each value its sum over the rows of the group from this position on, as ``sum_<value>``; chunk by chunk, so
    that a long group is many tasks."""
    chunked = df.withColumn("_c", F.floor(F.col(position) / CHUNK))
    sums = chunked.groupBy(*by, "_c").agg(*[F.sum(v).alias(v) for v in values])
    behind = Window.partitionBy(*by).orderBy("_c").rowsBetween(1, Window.unboundedFollowing)
    rest = sums.select(*by, "_c", *[F.sum(v).over(behind).alias(f"_{v}") for v in values]).where(F.col(f"_{values[0]}").isNotNull())
    inside = Window.partitionBy(*by, "_c").orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = chunked.withColumns({f"sum_{v}": F.sum(v).over(inside) for v in values})
    total = {f"sum_{v}": F.col(f"sum_{v}") + F.coalesce(f"_{v}", F.lit(0)) for v in values}
    return own.join(rest, [*by, "_c"], "left").withColumns(total).drop("_c", *[f"_{v}" for v in values])


def _segments(nodes: DataFrame) -> DataFrame:
    """Stretches of nodes with the same members (equal rep and number of members): one row each with its parent segment,
    children, and the leaves and saved tokens of the whole subtree below its top.

    Segments with one rep form a path. A path's totals are added to the segment that it branches off; from there they go
    on along that segment's path, and so on to the root. As a rep is the member of least random rank, on the way up from
    any node the rep changes about ln(members) times, however deep the trie is; each round below handles one change.
    """
    key = ["rep", "n_convs"]
    top = [F.min_by(c, "depth").alias(c) for c in ("q1", "q2")]
    bottom = [F.max_by(c, "depth").alias(c) for c in ("p1", "p2")]
    segments = nodes.groupBy(*key).agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("first_id").alias("first_id"),
        ((F.col("n_convs") - 1) * F.sum("n_chars")).alias("own"), *top, *bottom,
    )
    segments = store(segments, "segments")
    above = segments.select(
        F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("rep").alias("parent_rep"), F.col("n_convs").alias("parent_n"),
        F.col("top").alias("parent_top"), F.col("first_id").alias("parent_id"),
    )
    placed = segments.where("top > 0").join(above, ["q1", "q2"]).unionByName(segments.where("top = 0"), allowMissingColumns=True)
    placed = store(placed.drop("q1", "q2", "p1", "p2"), "placed")
    children = placed.where("parent_rep IS NOT NULL").groupBy("parent_rep", "parent_n").agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed({"parent_rep": "rep", "parent_n": "n_convs"})
    placed = placed.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    placed = store(placed, "children")

    links = placed.where("parent_rep <> rep").select("rep", "parent_rep", "parent_top")
    arrived = placed.select("rep", "top", (F.col("n_children") == 0).cast("bigint").alias("leaves"), F.col("own").alias("saved"))
    total = arrived
    while True:
        sums = arrived.groupBy("rep").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        onward = sums.join(links, "rep").groupBy(F.col("parent_rep").alias("rep"), F.col("parent_top").alias("top"))
        arrived = store(onward.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "arrived")
        if arrived.isEmpty():
            break
        total = total.unionByName(arrived)
    at_segment = total.groupBy("rep", "top").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    below = _from_here(at_segment, ["rep"], "top", ["leaves", "saved"]).select("rep", "top", F.col("sum_leaves").alias("n_leaves"), "sum_saved")
    return placed.join(below, ["rep", "top"]).select(
        *key, "top", "bottom", "parent_id", F.col("n_children").alias("below"), "n_leaves", (F.col("sum_saved") - F.col("own")).alias("saved_below")
    )


def _digest_in_order(chunks: DataFrame) -> DataFrame:
    """``p1, p2, ends_sha256`` of id lists that come as several ``chunk, ids``.

    SHA-256 runs through a list in order, so a list is one task's work; it passes through as a stream of chunks of which
    one is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ids")), strict=True):
                if (p1, p2) != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (p1, p2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digest_batch(out)
        if node is not None:
            yield _digest_batch([(*node, digest.hexdigest())])

    dealt = chunks.select("p1", "p2", "chunk", "ids").repartition("p1", "p2").sortWithinPartitions("p1", "p2", "chunk")
    return dealt.mapInArrow(run, "p1 bigint, p2 bigint, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["p1", "p2", "ends_sha256"])


def _ends(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """``p1, p2, ends_sha256`` of the nodes where conversations end: hash of their decimal ids, ascending, comma-joined."""
    whole = blocks.groupBy("conv_id").agg(F.bit_xor("h1").alias("p1"), F.bit_xor("h2").alias("p2"))
    turnless = members.join(whole, "conv_id", "left_anti").withColumns({"p1": F.lit(0).cast("bigint"), "p2": F.lit(0).cast("bigint")})
    ends = whole.unionByName(turnless).withColumn("chunk", F.floor(F.col("conv_id") / CHUNK))
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))  # at most CHUNK of them
    chunks = store(ends.groupBy("p1", "p2", "chunk").agg(F.array_join(ids, ",").alias("ids")), "ends")
    lists = chunks.groupBy("p1", "p2").agg(F.count("*").alias("n"), F.max(F.sha2("ids", 256)).alias("ends_sha256"))
    several = lists.where("n > 1").select("p1", "p2")
    return lists.where("n = 1").drop("n").unionByName(_digest_in_order(chunks.join(several, ["p1", "p2"], "left_semi")))


def trie_nodes(turns: DataFrame, members: DataFrame, *, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie of turn sequences: one row per distinct sequence of first d turns, the textless root included.

    ``turns`` is as from ``ordered_turns`` (indices from 0 without gaps), ``members`` holds the distinct ``conv_id``s, those
    without turns included. Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the subtree, each node's members
    but one times the code points of its last text) and ``ends_sha256`` (of the ids that end there; none: of the empty
    string). (conv_id, depth) identifies a node. No conversations: no rows.

    Sequences are compared as 128-bit digests. Copies and shared beginnings are reduced before they are shuffled, and
    nothing is gathered per node; long conversations are cut into chunks.
    """
    blocks = store(_blocks(turns, block_turns), "prefixes")
    nodes = store(_nodes(blocks, members), "nodes")
    segments = _segments(nodes)
    shared = _from_here(nodes.where("n_convs > 1"), ["rep", "n_convs"], "depth", ["n_chars"])
    alone = nodes.where("n_convs = 1").withColumn("sum_n_chars", F.lit(0).cast("bigint"))
    rows = shared.unionByName(alone).join(segments, ["rep", "n_convs"]).join(_ends(blocks, members), ["p1", "p2"], "left")
    parent = F.when(F.col("depth") > F.col("top"), F.col("first_id")).otherwise(F.col("parent_id"))
    children = F.when(F.col("depth") < F.col("bottom"), F.lit(1)).otherwise(F.col("below"))
    return rows.select(
        F.col("first_id").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", children.cast("bigint").alias("n_children"),
        "n_leaves", ((F.col("n_convs") - 1) * F.col("sum_n_chars") + F.col("saved_below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def prefix_trie(
    conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """``trie_nodes`` of the conversations as they are; see ``ordered_turns`` for nulls, ties and repeated rows."""
    turns = store(ordered_turns(conversations, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col), "turns")
    return trie_nodes(turns, turns.select("conv_id").distinct(), block_turns=block_turns)
