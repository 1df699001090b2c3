"""Prefix trie of conversations: double-array tries per prefix shard, merged at the top.

1. Turns are named by hashes of (role, text), ordered inside their conversation by a range
   partitioning (a conversation of any length is divided) and rebuilt by a rule.
2. A rebuilt conversation is cut into segments of at most SEGMENT turns. A node's key is the XOR of
   the hashes of (position, turn) along its prefix, 128 bits wide, so every segment knows the
   key of the node it starts from. Equal segments from one node become one item with a
   weight.
3. Items are dealt to shards by their start and first turn; a first turn with more than SHARD_TURNS turns
   below it is dealt to several shards. A shard numbers its distinct turns densely,
   packs its trie into BASE and CHECK arrays (the child of state s by turn id t is BASE[s] + t
   where CHECK is s) and walks all items through them at once to count.
4. Nodes that only one shard can hold are finished there. Starts of segments and nodes of divided first turns
   are shared: their partial counts are merged by key, and subtree sums climb the shared part
   of the tree by pointer doubling.

Defined cases: rows with a null conv_id belong to no conversation and are left out; a null turn
comes first; equal turn numbers are ordered by the hash of their content, repeated rows are turns of their own;
an empty table gives no rows; texts of any length are whole. conv_id % 20 has the sign of
conv_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import join_uneven, parts_for, python_tasks, stored

SEGMENT = 1 << 12
SHARD_TURNS = 1 << 17
TURNS_PER_PART = 1 << 20
# Conversations whose ids (in one run of so many numbers) are joined to a text at once.
ENDS_AT_ONCE = 1 << 16
FAMILY = 20
HEADS = 4
# First-fit places tried for a node of several children before it goes to the end.
TRIES = 64

NODE = (
    "k1 bigint, k2 bigint, depth bigint, p1 bigint, p2 bigint, shared boolean, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, words bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
)


# The double array.


class DoubleArray:
    """A trie over sequences of turn ids: `base` and `check` by state; state 0 is the top."""

    def __init__(self, base: np.ndarray, check: np.ndarray):
        self.base, self.check = base, check

    @classmethod
    def of(cls, sequences: list[np.ndarray]) -> DoubleArray:
        parents, ids = _edges(sequences)
        n = len(parents) + 1
        starts = np.flatnonzero(np.diff(parents, prepend=-1))
        degree = np.diff(np.append(starts, len(parents)))
        free = np.ones(n + 1, dtype=bool)
        free[0] = False
        place = np.zeros(n, dtype=np.int64)  # of every node; node i + 1 is reached by edge i
        base = np.zeros(n, dtype=np.int64)  # by node
        order = np.argsort(-degree, kind="stable")
        several = order[degree[order] > 1]
        first = 1
        for k in several:
            a, own = starts[k], ids[starts[k] : starts[k] + degree[k]]
            while first < len(free) and not free[first]:
                first += 1
            at = first + np.flatnonzero(free[first : first + 4 * TRIES])[:TRIES] - own[0]
            slots = at[:, None] + own[None, :]
            fits = ((slots >= len(free)) | free[np.minimum(slots, len(free) - 1)]).all(axis=1)
            b = int(at[np.argmax(fits)]) if fits.any() else len(free) - int(own[0])
            top = b + int(own[-1])
            if top >= len(free):
                free = np.concatenate([free, np.ones(max(len(free), top + 1 - len(free)), dtype=bool)])
            free[b + own] = False
            base[parents[a]] = b
            place[a + 1 : a + 1 + degree[k]] = b + own
        single = starts[degree == 1]
        slots = np.flatnonzero(free)
        slots = np.append(slots, np.arange(len(free), len(free) + max(0, len(single) - len(slots))))[: len(single)]
        base[parents[single]] = slots - ids[single]
        place[single + 1] = slots
        size = int(place.max()) + 1
        out = cls(np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64))
        out.base[place] = base
        out.check[place[1:]] = place[parents]
        return out

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The children of `states` by `ids`; a missing one raises KeyError."""
        to = self.base[states] + ids
        inside = (to > 0) & (to < len(self.check))
        if not inside.all() or (self.check[to] != states).any():
            raise KeyError("no such child")
        return to


def _edges(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(parent node, turn id) of every node but the top, grouped by parent; ids ascend.

    Nodes are numbered by level, so an edge's own number is that of its child less one.
    """
    lengths = np.array([len(s) for s in sequences])
    at = np.zeros(len(sequences), dtype=np.int64)
    parents, ids, seen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
    for level in range(int(lengths.max(initial=0))):
        rows = np.flatnonzero(lengths > level)
        own = np.array([sequences[i][level] for i in rows], dtype=np.int64)
        pairs, number = np.unique(np.stack([at[rows], own]), axis=1, return_inverse=True)
        at[rows] = number.ravel() + seen
        seen += pairs.shape[1]
        parents.append(pairs[0])
        ids.append(pairs[1])
    return np.concatenate(parents), np.concatenate(ids)


class Shard:
    """The items of one shard: a trie below the nodes that they start from."""

    def __init__(self, items: list[tuple]):
        self.starts = np.array([i[:3] for i in items], dtype=np.int64)  # k1, k2, depth
        self.low, self.weight, self.shared = (np.array([i[k] for i in items], dtype=np.int64) for k in (3, 4, 5))
        self.turns = [i[6] for i in items]  # columns: two names, two hashes, words

    def nodes(self) -> list[np.ndarray]:
        """The columns of NODE for every node, and for every start what it has in this shard."""
        lengths = np.array([len(t) for t in self.turns])
        flat = np.concatenate(self.turns)
        _, ids = np.unique(flat[:, :2], axis=0, return_inverse=True)
        tops, top = np.unique(self.starts, axis=0, return_inverse=True)
        ids, top = ids.ravel() + len(tops), top.ravel()
        ends = np.cumsum(lengths)
        sequences = [np.concatenate([[t], ids[e - n : e]]) for t, n, e in zip(top, lengths, ends)]
        trie = DoubleArray.of(sequences)
        size = len(trie.check)
        out = {c: np.zeros(size, dtype=np.int64) for c in ("k1", "k2", "depth", "n", "shared", "words")}
        low = np.full(size, np.iinfo(np.int64).max)
        state = trie.step(np.zeros(len(top), dtype=np.int64), top)
        key = self.starts[:, :2].copy()
        for c, v in zip(("k1", "k2", "depth"), self.starts.T):
            out[c][state] = v
        out["shared"][state] = 2
        for level in range(int(lengths.max())):
            rows = np.flatnonzero(lengths > level)
            here = ends[rows] - lengths[rows] + level
            state[rows] = s = trie.step(state[rows], ids[here])
            key[rows] ^= flat[here, 2:4]
            out["k1"][s], out["k2"][s] = key[rows, 0], key[rows, 1]
            out["depth"][s] = self.starts[rows, 2] + level + 1
            out["words"][s] = flat[here, 4]
            np.add.at(out["n"], s, self.weight[rows])
            np.maximum.at(out["shared"], s, self.shared[rows])
            np.minimum.at(low, s, self.low[rows])
        return self._summed(trie, out, low)

    def _summed(self, trie: DoubleArray, out: dict[str, np.ndarray], low: np.ndarray) -> list[np.ndarray]:
        """Sums over finished children climb from the deepest level; shared nodes keep theirs apart."""
        used = np.flatnonzero(trie.check > 0)
        tops = np.flatnonzero(trie.check == 0)
        finished = out["shared"] == 0
        children, leaves, saved = (np.zeros(len(trie.check), dtype=np.int64) for _ in range(3))
        order = used[np.argsort(-out["depth"][used], kind="stable")]
        for s in np.split(order, np.flatnonzero(np.diff(out["depth"][order])) + 1) if len(order) else []:
            s = s[finished[s]]
            leaves[s] += children[s] == 0
            saved[s] += (out["n"][s] - 1) * out["words"][s]
            above = trie.check[s]
            np.add.at(children, above, 1)
            np.add.at(leaves, above, leaves[s])
            np.add.at(saved, above, saved[s])
        rows = np.concatenate([tops, used])
        above = trie.check[rows]
        is_top = np.arange(len(rows)) < len(tops)
        unknown = is_top | ~finished[above]
        nullable = lambda v, null: pa.array(v, mask=null)
        return [
            pa.array(out["k1"][rows]), pa.array(out["k2"][rows]), pa.array(out["depth"][rows]),
            nullable(out["k1"][above], is_top), nullable(out["k2"][above], is_top), pa.array(~finished[rows]),
            nullable(low[rows], is_top), nullable(low[above], unknown),
            pa.array(out["n"][rows]), pa.array(out["words"][rows]), pa.array(children[rows]),
            pa.array(leaves[rows]), pa.array(saved[rows]),
        ]


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in NODE.split(", ")]
    current, items = None, []
    for b in batches:
        narrow = zip(*[b[c].to_pylist() for c in ("shard", "k1", "k2", "depth", "low", "weight", "shared")])
        for i, (shard, *own) in enumerate(narrow):
            if shard != current:
                if items:
                    yield pa.record_batch(Shard(items).nodes(), names)
                current, items = shard, []
            fields = b["turns"][i].values.flatten()[1:]
            items.append((*own, np.stack([np.asarray(f, dtype=np.int64) for f in fields], axis=1)))
    if items:
        yield pa.record_batch(Shard(items).nodes(), names)


# Conversations.


def _ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, d, e, words): the turns of each conversation, numbered from 0.

    Rows are ranged by (conv_id, turn, content), so a long conversation spans tasks; the count
    before a range is needed for the one conversation that it continues.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")
    named = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("d"),
        F.xxhash64(F.lit(1), text, role).alias("e"),
        words.alias("words"),
    )
    keys = ["conv_id", "turn", "d", "e"]
    grouped = stored(named.groupBy(*keys).agg(F.max("words").alias("words"), F.count("*").alias("copies")), "turns")
    parts = parts_for(conversations.sparkSession, grouped.count(), TURNS_PER_PART)
    ranged = stored(
        grouped.repartitionByRange(parts, *[F.asc_nulls_first(k) for k in keys]).withColumn("part", F.spark_partition_id()),
        "ranged-turns",
    )
    before = Window.partitionBy("part", "conv_id").orderBy(*[F.asc_nulls_first(k) for k in keys[1:]])
    inner = F.sum("copies").over(before.rowsBetween(Window.unboundedPreceding, -1))
    sums = ranged.groupBy("conv_id", "part").agg(F.sum("copies").alias("copies"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("carried", F.sum("copies").over(earlier)).filter("carried is not null")
    placed = ranged.withColumn("inner", F.coalesce(inner, F.lit(0))).join(
        F.broadcast(carried.select("conv_id", "part", "carried")), ["conv_id", "part"], "left"
    )
    first = F.col("inner") + F.coalesce("carried", F.lit(0))
    return placed.select(
        "conv_id", F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("pos"), "d", "e", "words"
    )


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, total) of every conversation, (conv_id, pos, d, e, words) of its rebuilt turns)."""
    lengths = own.groupBy("conv_id").agg((F.max("pos") + 1).alias("length"))
    base = lengths.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    taken = F.least("h", F.coalesce("base_length", F.lit(0))).cast("bigint")
    convs = stored(
        lengths.withColumn("h", head_length(F.col("conv_id")))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(base, "base", "left")
        .select("conv_id", "base", "length", "h", taken.alias("taken")),
        "conversations",
    )
    heads = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    heads = convs.join(heads, "base").filter("pos < taken").select("conv_id", "pos", "d", "e", "words")
    # One row of `convs` for every SEGMENT own turns, so that a long conversation is no single key.
    spread = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(length - 1) div {SEGMENT}")))
    wide = convs.filter("length > h").select("conv_id", "h", "taken", spread.alias("run"))
    tails = (
        own.withColumn("run", F.expr(f"pos div {SEGMENT}"))
        .join(wide, ["conv_id", "run"])
        .filter("pos >= h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "d", "e", "words")
    )
    total = F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))
    return convs.select("conv_id", total.alias("total")), heads.unionByName(tails)


def _segments(turns: DataFrame) -> DataFrame:
    """(conv_id, k1, k2, depth, x1, x2, n, turns): segments with the key and depth they start from."""
    hashed = turns.withColumns(
        {"z1": F.xxhash64("pos", "d", "e"), "z2": F.xxhash64(F.lit(1), "e", "pos", "d"), "run": F.expr(f"pos div {SEGMENT}")}
    )
    cut = hashed.groupBy("conv_id", "run").agg(
        F.sort_array(F.collect_list(F.struct("pos", "d", "e", "z1", "z2", "words"))).alias("turns"),
        F.bit_xor("z1").alias("x1"),
        F.bit_xor("z2").alias("x2"),
        F.count("*").alias("n"),
    )
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return cut.select(
        "conv_id",
        F.coalesce(F.bit_xor("x1").over(before), zero).alias("k1"),
        F.coalesce(F.bit_xor("x2").over(before), zero).alias("k2"),
        (F.col("run") * SEGMENT).alias("depth"),
        "x1",
        "x2",
        "n",
        "turns",
    )


def _items(segments: DataFrame) -> DataFrame:
    """Distinct segments with `weight`, the smallest conversation `low`, and their shard."""
    start = ["k1", "k2", "depth"]
    equal = segments.groupBy(*start, "x1", "x2", "n").agg(
        F.min("conv_id").alias("low"), F.count("*").alias("weight"), F.first("turns").alias("turns")
    )
    items = stored(equal.withColumn("lead", F.col("turns")[0]["z1"]), "segments")
    prefixes = items.groupBy(*start, "lead").agg(F.sum("n").alias("below"))
    total = items.agg(F.sum("n")).first()[0] or 0
    # At most one prefix in SHARD_TURNS turns is divided.
    divided = prefixes.filter(F.col("below") > SHARD_TURNS).select(
        *start, "lead", F.expr(f"(below + {SHARD_TURNS - 1}) div {SHARD_TURNS}").alias("pieces")
    )
    shards = parts_for(segments.sparkSession, total, SHARD_TURNS)
    salt = F.pmod(F.xxhash64("x1", "x2"), F.coalesce("pieces", F.lit(1)))
    return items.join(F.broadcast(divided), [*start, "lead"], "left").select(
        F.pmod(F.xxhash64(*start, "lead", salt), F.lit(shards)).alias("shard"),
        *start,
        "low",
        "weight",
        # A whole segment may go on in another shard.
        (F.col("pieces").isNotNull() | (F.col("n") == SEGMENT)).cast("bigint").alias("shared"),
        "turns",
    ).repartition(shards, "shard").sortWithinPartitions("shard")


# Shared nodes.


def _climbed(nodes: DataFrame, count: int, levels: int) -> DataFrame:
    """(k1, k2, n_leaves, saved_tokens) summed over subtrees of the tree (k1, k2, p1, p2).

    After round r a node has the sums of all descendants less than 2**r below it, and jumps
    2**r up.
    """
    sums = nodes.select("k1", "k2", F.col("p1").alias("j1"), F.col("p2").alias("j2"), "n_leaves", "saved_tokens")
    reach = 1
    while reach <= levels:
        landing = (
            sums.filter("j1 is not null")
            .groupBy(F.col("j1").alias("k1"), F.col("j2").alias("k2"))
            .agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("jumps"))
        )
        added = stored(sums.join(landing, ["k1", "k2"], "left"), "climbed")
        targets = added.filter("jumps > 0").select(
            F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("j1").alias("n1"), F.col("j2").alias("n2"), "jumps"
        )
        own = added.select(
            "k1", "k2", "j1", "j2",
            (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
        )
        moved = join_uneven(own.filter("j1 is not null"), targets, ["j1", "j2"], "jumps", count).select(
            "k1", "k2", F.col("n1").alias("j1"), F.col("n2").alias("j2"), "n_leaves", "saved_tokens"
        )
        sums = stored(moved.unionByName(own.filter("j1 is null")), "climbed")
        reach *= 2
    return sums.drop("j1", "j2")


def _merged(partial: DataFrame, convs: DataFrame) -> DataFrame:
    """The shared nodes (the columns of NODE) with their whole counts."""
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("words", "n_children", "n_leaves", "saved_tokens")]
    none = [F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2")]
    key = [F.lit(0).cast("bigint").alias(c) for c in ("k1", "k2", "depth")]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    columns = ["k1", "k2", "depth", "p1", "p2", "conv_id", "n_convs", "words", "n_children", "n_leaves", "saved_tokens"]
    parts = partial.select(*columns).unionByName(root.select(*key, *none, "conv_id", "n_convs", *zero))
    nodes = stored(
        parts.groupBy("k1", "k2", "depth").agg(
            *[F.max(c).alias(c) for c in ("p1", "p2", "words")],
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "shared-nodes",
    )
    count, deepest = nodes.agg(F.count("*"), F.max("depth")).first()
    inner = nodes.filter("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("more"))
    children = F.col("n_children") + F.coalesce("more", F.lit(0))
    own = stored(
        nodes.join(inner, ["k1", "k2"], "left")
        .withColumn("n_children", children)
        .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
        .drop("more"),
        "shared-nodes",
    )
    sums = _climbed(own, count, deepest or 0)
    return stored(own.drop("n_leaves", "saved_tokens").join(sums, ["k1", "k2"]), "shared-nodes")


def _ends(segments: DataFrame, convs: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): the digest of the ids of the conversations that end at a node.

    Ids are joined to texts by runs of ENDS_AT_ONCE numbers; a node's texts then pass through one
    digest in order, never held together.
    """
    zero = F.lit(0).cast("bigint")
    last = segments.groupBy("conv_id").agg(F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"))
    none = convs.filter("total = 0").select("conv_id", zero.alias("k1"), zero.alias("k2"))
    joined = (
        last.unionByName(none)
        .groupBy("k1", "k2", F.shiftright("conv_id", ENDS_AT_ONCE.bit_length() - 1).alias("run"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string()]
        row = lambda *v: pa.record_batch([pa.array(x, k) for x, k in zip(v, kinds)], ["k1", "k2", "ends_sha256"])
        current, digest = None, None
        for b in batches:
            done: list[tuple] = []
            for k1, k2, ids in zip(*[b[c].to_pylist() for c in ("k1", "k2", "ids")]):
                if (k1, k2) == current:
                    digest.update(b"," + ids.encode())
                    continue
                if current:
                    done.append((*current, digest.hexdigest()))
                current, digest = (k1, k2), hashlib.sha256(ids.encode())
            if done:
                yield row(*zip(*done))
        if current:
            yield row([current[0]], [current[1]], [digest.hexdigest()])

    return (
        joined.repartition("k1", "k2")
        .sortWithinPartitions("k1", "k2", "run")
        .select("k1", "k2", "ids")
        .mapInArrow(digests, "k1 bigint, k2 bigint, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over the rebuilt (conv_id, turn, role, text)."""
    python_tasks(conversations.sparkSession)
    own = stored(_ordered_turns(conversations), "own-turns")
    convs, turns = _rebuilt(own)
    segments = stored(_segments(turns), "conversation-segments")
    nodes = stored(_items(segments).mapInArrow(_shard_nodes, NODE), "trie-nodes")
    shared = _merged(nodes.filter("shared"), convs)
    of_parent = shared.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    columns = ["k1", "k2", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    finished = nodes.filter("not shared")
    below = finished.filter("parent_conv_id is null").unionByName(shared.filter("p1 is not null"), allowMissingColumns=True)
    rows = below.select(*columns, "p1", "p2")
    held = shared.agg(F.sum("n_children")).first()[0] or 1
    linked = join_uneven(rows, of_parent.withColumnRenamed("n_children", "held"), ["p1", "p2"], "held", held)
    top = shared.filter("p1 is null").select(*columns, F.lit(None).cast("bigint").alias("parent_conv_id"))
    everything = (
        finished.filter("parent_conv_id is not null")
        .select(*columns, "parent_conv_id")
        .unionByName(linked.select(*columns, "parent_conv_id"))
        .unionByName(top)
    )
    return everything.join(_ends(segments, convs), ["k1", "k2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
