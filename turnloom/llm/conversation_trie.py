"""The prefix trie of conversations: one node for each distinct sequence of first turns.

A turn is digested first, so texts aren't shuffled. A conversation's prefixes get
chained digests: each is hashed from the one before and the next turn. Chains
run in blocks of turns, and blocks are chained in turn, so that an endless
conversation is spread over tasks. Every prefix is exploded, and (depth,
digest) groups are the nodes. A node is known by its smallest member and its
depth. For sums over subtrees each node is exploded to all its ancestors, up to
BLOCK levels at a time: first by single levels, then by strides of
BLOCK, BLOCK^2 and so on, as a conversation of n turns would make n * n / 2 rows otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_order, sums_before, word_count, written

#: Turns chained in one cell, and ancestors that a node is exploded to at once.
BLOCK = 32
#: Ids that are joined to one text before texts are joined.
JOINED_IDS = 5_000


def ordered_turns(conversations: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(conv_id, pos, digest, words): a conversation's turns numbered from 0 by turn, null first.

    A null role or text counts as empty. Turns of one number, repeated rows among them, all stay, in the
    order of their digests. Rows without a conversation take no part.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_column, text_column))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    slim = conversations.where(F.col(conv_column).isNotNull()).select(F.col(conv_column).cast("long").alias("conv_id"), F.col(turn_column).alias("turn"), digest.alias("digest"), word_count(F.col(text_column)).alias("words"))
    rows = in_order(slim, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")], "trie-turns").withColumn("one", F.lit(1).cast("long"))
    return cut(sums_before(rows, ["conv_id", "part"], [F.col("at")], "one", "pos").select("conv_id", "pos", "digest", "words"))


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """turns, rebuilt: (conv_id, n_turns, depth, digest, words), depth from 1; a conversation without turns has one row of depth 0.

    Conversation c begins with the first h turns of conversation c - c % every (all if it has fewer, none if
    it isn't there), then come its own after its first h; h is crc32(c as text) % most.
    """
    conv = F.col("conv_id")
    h = F.pmod(F.crc32(conv.cast("string")), F.lit(most)).cast("long")
    sizes = cut(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    about = sizes.select(conv, "n", h.alias("h"), (conv - conv % every).alias("head")).join(sizes.select(conv.alias("head"), F.col("n").alias("_n")), "head", "left")
    about = about.withColumn("m", F.least("h", F.coalesce("_n", F.lit(0).cast("long"))))
    about = cut(about.select("conv_id", "head", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")))
    # a head is at most `most` rows, for at most 2 * every conversations
    heads = turns.where(F.col("pos") < most).select(conv.alias("head"), "pos", "digest", "words").join(about.where("m > 0"), "head").where("pos < m")
    own = turns.where(F.col("pos") >= h).join(about, "conv_id")
    row = lambda df, depth: df.select("conv_id", "n_turns", depth.cast("long").alias("depth"), "digest", "words")
    none = about.where("n_turns = 0").withColumns({"digest": F.lit(None).cast("binary"), "words": F.lit(0).cast("long")})
    return row(heads, F.col("pos") + 1).unionByName(row(own, F.col("m") + F.col("pos") - F.col("h") + 1)).unionByName(row(none, F.lit(0)))


def whole_conversations(turns: DataFrame) -> DataFrame:
    """turns as they are, in the form of with_shared_heads."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    return turns.join(sizes, "conv_id").select("conv_id", "n_turns", (F.col("pos") + 1).alias("depth"), "digest", "words")


def _hash(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _chained(items: Column) -> Column:
    """The chained digests of an array of structs with a digest."""
    empty = F.array(F.unhex(F.lit("")))
    chain = F.aggregate(items, empty, lambda a, x: F.concat(a, F.array(_hash(F.concat(F.element_at(a, -1), x["digest"])))))
    return F.slice(chain, F.lit(2), F.size(items))


def _starts(blocks: DataFrame, blocks_each: int) -> DataFrame:
    """(conv_id, block, start): the digest of all blocks before, from blocks(conv_id, block, digest), numbered from 0."""
    if blocks_each <= 1:
        return blocks.select("conv_id", "block", F.unhex(F.lit("")).alias("start"))
    groups = blocks.withColumn("up", F.floor(F.col("block") / BLOCK)).groupBy("conv_id", "up").agg(F.array_sort(F.collect_list(F.struct("block", "digest"))).alias("items"))
    groups = cut(groups.withColumn("chain", _chained(F.col("items"))))
    above = _starts(groups.select("conv_id", F.col("up").alias("block"), F.element_at("chain", -1).alias("digest")), -(-blocks_each // BLOCK))
    both = groups.join(above.withColumnRenamed("block", "up"), ["conv_id", "up"])
    rows = both.select("conv_id", "start", F.explode(F.transform("items", lambda x, i: F.struct(x["block"].alias("block"), F.when(i > 0, F.get("chain", i - 1)).otherwise(F.unhex(F.lit(""))).alias("inner")))).alias("x"))
    return rows.select("conv_id", "x.block", _hash(F.concat("start", "x.inner")).alias("start"))


def prefixes(rebuilt: DataFrame, deepest: int) -> DataFrame:
    """(conv_id, depth, digest, words, last): every prefix of every conversation, the empty one too; deepest is the greatest depth."""
    turns = rebuilt.where("depth > 0").withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    blocks = turns.groupBy("conv_id", "n_turns", "block").agg(F.array_sort(F.collect_list(F.struct("depth", "digest", "words"))).alias("items"))
    blocks = blocks.withColumn("chain", _chained(F.col("items")))
    each = -(-deepest // BLOCK)
    if each > 1:
        blocks = written(blocks, "trie-blocks")
        starts = _starts(blocks.select("conv_id", "block", F.element_at("chain", -1).alias("digest")), each)
        blocks = blocks.join(starts, ["conv_id", "block"]).withColumn("chain", F.transform("chain", lambda c: _hash(F.concat("start", c))))
    one = blocks.select("conv_id", "n_turns", F.explode(F.transform("items", lambda x, i: F.struct(x["depth"].alias("depth"), F.get("chain", i).alias("digest"), x["words"].alias("words")))).alias("x"))
    deep = one.select("conv_id", "x.depth", "x.digest", "x.words", (F.col("x.depth") == F.col("n_turns")).alias("last"))
    root = rebuilt.where("depth <= 1").select("conv_id", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit("")).alias("digest"), F.lit(0).cast("long").alias("words"), (F.col("n_turns") == 0).alias("last"))
    return deep.unionByName(root)


def _sums(nodes: DataFrame, paths: DataFrame, stride: int, first: int) -> DataFrame:
    """Each node's leaves and saved exploded to the ancestors first .. BLOCK - 1 strides above, summed for each of these."""
    up = nodes.select("conv_id", "depth", "leaves", "saved", F.explode(F.sequence(F.lit(first).cast("long"), F.least(F.lit(BLOCK - 1).cast("long"), F.floor(F.col("depth") / stride)))).alias("j"))
    up = up.where(F.col("j") * stride <= F.col("depth")).select("conv_id", (F.col("depth") - F.col("j") * stride).alias("depth"), "leaves", "saved", "j")
    there = up.join(paths.select("conv_id", "depth", "node"), ["conv_id", "depth"])
    return there.groupBy(F.col("node").alias("conv_id"), "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count_if(F.lit(stride == 1) & (F.col("j") == 1)).alias("n_children"))


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of each node's ends(conv_id, depth, member): the members in order, joined by commas.

    Members are sorted by ranges and joined some at a time; only a node with more than that is read, piece
    by piece and in order, by one task, as its hash can't be had otherwise.
    """
    key = ["conv_id", "depth"]
    rows = in_order(ends, [F.col(c) for c in (*key, "member")], "trie-ends")
    piece = F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / JOINED_IDS)
    some = rows.groupBy(*key, "part", piece.alias("piece")).agg(F.min("at").alias("at"), F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    some = written(some.select(*key, "at", "ids"), "trie-pieces")
    count = some.groupBy(*key).agg(F.count("*").alias("n"), F.min("ids").alias("ids"))
    count = cut(count.select(*key, "n", F.when(F.col("n") == 1, F.sha2("ids", 256)).alias("ends_sha256")))

    def hashed(node: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, before = hashlib.sha256(), -1
        for part in parts:
            for at, ids in zip(part.column("at").to_pylist(), part.column("ids").to_pylist(), strict=True):
                if at <= before:
                    raise ValueError("a node's ids must come in order")
                made.update((b"," if before >= 0 else b"") + ids.encode())
                before = at
        yield pa.RecordBatch.from_arrays([pa.array([node[0].as_py()], pa.int64()), pa.array([node[1].as_py()], pa.int64()), pa.array([made.hexdigest()])], names=[*key, "ends_sha256"])

    many = some.join(count.where("n > 1").select(*key), key, "left_semi").repartition(*key).sortWithinPartitions(*key, "at")
    long = many.groupBy(*key).applyInArrow(hashed, "conv_id long, depth long, ends_sha256 string")
    return count.where("n = 1").drop("n").unionByName(long)


def prefix_trie(rebuilt: DataFrame) -> DataFrame:
    """The nodes of conversations given by rebuilt(conv_id, n_turns, depth, digest, words), as with_shared_heads makes them.

    (conv_id, depth, parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens, ends_sha256): a
    node's smallest member, its parent's (null for the root), its members, those that end at it, its children, the
    childless nodes of its subtree, the words that its subtree saves if each node's last turn is kept once, and the
    hash of the ids of those that end at it. Without conversations there is no node.
    """
    rebuilt = cut(rebuilt)
    deepest = rebuilt.agg(F.max("depth")).first()[0]
    every = written(prefixes(rebuilt, deepest or 0), "trie-prefixes")
    nodes = cut(every.groupBy("depth", "digest").agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"), F.max("words").alias("words")))
    root = every.agg(F.min("conv_id")).first()[0]
    # every conversation has the root, so it isn't joined
    paths = every.where("depth > 0").join(nodes.where("depth > 0").select("depth", "digest", "node"), ["depth", "digest"]).select("conv_id", "depth", "node", "last")
    paths = cut(paths.unionByName(every.where("depth = 0").select("conv_id", "depth", F.lit(root).cast("long").alias("node"), "last")))
    known = nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "n_ends", "words")
    own = known.select("conv_id", "depth", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    sums = cut(_sums(own, paths, 1, 0))
    stride = BLOCK
    while stride <= (deepest or 0):
        more = sums.unionByName(_sums(sums.where(F.col("depth") >= stride), paths, stride, 1))
        sums = cut(more.groupBy("conv_id", "depth").agg(*(F.sum(c).alias(c) for c in ("leaves", "saved", "n_children"))))
        stride *= BLOCK
    key = ["conv_id", "depth"]
    parents = known.where("depth > 0").select("conv_id", (F.col("depth") - 1).alias("depth")).join(paths.select("conv_id", "depth", F.col("node").alias("parent_conv_id")), key).withColumn("depth", F.col("depth") + 1)
    ends = _joined_ids(paths.where("last").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member")))
    rows = known.join(sums, key).join(parents, key, "left").join(ends, key, "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
