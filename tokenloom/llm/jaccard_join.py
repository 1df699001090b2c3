"""N-gram Jaccard join by T-occurrence search over inverted lists.

Two documents link when their sets of word shingles have a Jaccard similarity of at least t, that is when
they share T = t / (1 + t) * (|x| + |y|) shingles. Steps, each exact:

1. Equal sets become one class; everything below is about classes.
2. Pre-selection. Each class offers the smaller part (share 1 - 2t/3) of its hashes. Linked
   classes share at least (t / 3) * |x| of those, so a class with fewer offered hashes that
   occur elsewhere links with nothing. Offers are counted per task before they are shuffled.
3. Lists. The remaining classes' shingles are ordered by list length, rare ones first.
4. Stars. Each class is first compared with the classes that lead most of its lists: those
   whose own shingles stand in the longest lists, and others at random. Rounds go on as long as they tie
   much. Classes tied like that need no further comparison among themselves.
5. Search. As in DivideSkip a class sets its L longest lists apart (L = APART % of t of its
   size). For every class the other lists that reach into several components are merged,
   with occurrences counted, and partners below T - L are left out. The others are probed: their
   whole sets are intersected, first one pair of every two components, then the pairs that
   are still apart. Long lists are divided into blocks of BLOCK members.
6. Connected components over the links, and back to all documents.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing;
repeated rows are documents of their own with equal sets; a null doc_id is never a
component_id unless nothing else is in the component; an empty table gives no rows; a text of any
length is one set, hashed in pieces and held by one task at a time. Shingles and sets are compared by
64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import free_names, join_uneven, python_tasks, small_side, stored
from tokenloom.llm.components import connected_components
from tokenloom.llm.shingles import shingle_sets
from tokenloom.llm.words import small_batches

THRESHOLD = 75  # in hundredths
OFFERS_PER_TASK = 1 << 21
# Texts whose offers are counted together before they are shuffled.
OFFER_BYTES = 1 << 24
BLOCK = 512
# The part of t * |x|, in hundredths, that a class sets apart: its longest lists, which are not merged.
APART = 93
# Leaders of a list (by so many different orders), those a class is compared with, and rounds of comparing.
LEADER_ORDERS = 3
LEADERS = 3
STAR_ROUNDS = 6


def _node(values: np.ndarray) -> int:
    digest = hashlib.blake2b(values.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small_batches(batches):
        sets = shingle_sets(b["text"])
        nodes = pa.array([_node(s) for s in sets], pa.int64())
        sizes = pa.array([len(s) for s in sets], pa.int64())
        yield pa.record_batch(
            [b["doc_id"], b["text_hash"], nodes, sizes], ["doc_id", "text_hash", "node", "n"]
        )


def _offers(threshold: int):
    """Rows (h, node, hits): a posting (hits -1), one that stands for several (0), or hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, most=OFFER_BYTES):
            sets: dict[int, np.ndarray] = {}
            for s in shingle_sets(b["text"]):
                if len(s):
                    sets.setdefault(_node(s), s[: len(s) - (2 * threshold * len(s)) // 300])
            if not sets:
                continue
            nodes = np.array(list(sets), dtype=np.int64)
            lengths = np.array([len(s) for s in sets.values()])
            h = np.concatenate(list(sets.values())).view(np.int64)
            owner = np.repeat(np.arange(len(nodes)), lengths)
            order = np.argsort(h, kind="stable")
            first = np.ones(len(h), dtype=bool)
            first[1:] = h[order][1:] != h[order][:-1]
            size = np.diff(np.append(np.flatnonzero(first), len(h)))
            several = np.empty(len(h), dtype=bool)
            several[order] = np.repeat(size > 1, size)
            leads = np.empty(len(h), dtype=bool)
            leads[order] = first
            kept = ~several | leads
            hits = np.bincount(owner[several], minlength=len(nodes))
            met = np.flatnonzero(hits)
            columns = [
                np.concatenate([h[kept], nodes[met]]),
                np.concatenate([nodes[owner[kept]], nodes[met]]),
                np.concatenate([several[kept].astype(np.int64) - 1, hits[met]]).astype(np.int32),
            ]
            for at in range(0, len(columns[0]), 1 << 18):
                yield pa.record_batch([pa.array(c[at : at + (1 << 18)]) for c in columns], ["h", "node", "hits"])

    return run


def _summed(nodes: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(nodes, return_inverse=True)
    return found, np.bincount(at, weights=hits, minlength=len(found)).astype(np.int64)


def _count_hits(groups: int):
    """(part, nodes, hits): the counts of one range of hashes, a row for each of `groups` groups of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = _hits_in_range(batches)
        if counted is None:
            return
        nodes, hits = counted
        part = nodes % groups
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.diff(part[order], prepend=-1))
        offsets = pa.array(np.append(starts, len(nodes)).astype(np.int32))
        yield pa.record_batch(
            [
                pa.array(part[order][starts].astype(np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(nodes[order])),
                pa.ListArray.from_arrays(offsets, pa.array(hits[order])),
            ],
            ["part", "nodes", "hits"],
        )

    return run


def _sum_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, hits) over all ranges; what is held is a number for every node met so far."""
    nodes, hits = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in batches:
        more = [np.asarray(b[c].flatten(), dtype=np.int64) for c in ("nodes", "hits")]
        nodes, hits = _summed(np.concatenate([nodes, more[0]]), np.concatenate([hits, more[1]]))
    yield pa.record_batch([pa.array(nodes), pa.array(hits)], ["node", "hits"])


def _hits_in_range(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray] | None:
    """(nodes, hits) of one range of hashes: postings whose hash another class offers too."""
    parts = [[np.asarray(b[c]) for c in ("h", "node", "hits")] for b in batches]
    if not parts:
        return None
    h, node, hits = (np.concatenate(x) for x in zip(*parts))
    counted = hits > 0
    nodes, amounts = [node[counted]], [hits[counted].astype(np.int64)]
    h, node, several = h[~counted], node[~counted], hits[~counted] == 0
    order = np.lexsort((node, h))
    h, node, several = h[order], node[order], several[order]
    new_list = np.ones(len(h), dtype=bool)
    new_list[1:] = h[1:] != h[:-1]
    new_node = new_list.copy()
    new_node[1:] |= node[1:] != node[:-1]
    number = np.cumsum(new_list) - 1
    lists = int(number[-1]) + 1 if len(number) else 0
    others = np.bincount(number, weights=new_node, minlength=lists) > 1
    others |= np.bincount(number, weights=several, minlength=lists) > 0
    hit = new_node & others[number] & ~several
    nodes.append(node[hit])
    amounts.append(np.ones(int(hit.sum()), dtype=np.int64))
    return _summed(np.concatenate(nodes), np.concatenate(amounts))


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small_batches(batches):
        sets = {}
        for s in shingle_sets(b["text"]):
            if len(s):
                sets.setdefault(_node(s), s)
        yield pa.record_batch(
            [
                pa.array(list(sets), pa.int64()),
                pa.array([s.view(np.int64) for s in sets.values()], pa.list_(pa.int64())),
            ],
            ["node", "hashes"],
        )


def _part(share: str, n: str = "n") -> Column:
    """ceil(share * n) for a share in hundredths, in whole numbers."""
    return F.expr(f"({share} * {n} + 99) div 100").cast("int")


def needed(n_x: str, n_y: str, threshold: int) -> Column:
    """The least number of shared shingles of linked sets of these sizes."""
    return F.expr(
        f"({threshold} * ({n_x} + {n_y}) + {99 + threshold}) div {100 + threshold}"
    )


def similar_size(n_x: Column, n_y: Column, threshold: int) -> Column:
    return (n_x * 100 >= n_y * threshold) & (n_y * 100 >= n_x * threshold)


def _candidate_sets(docs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """(node, n, hashes) of the classes that pass the pre-selection."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-total // OFFERS_PER_TASK))
    offers = docs.select("text").mapInArrow(_offers(threshold), "h bigint, node bigint, hits int")
    hits = (
        offers.repartition(tasks, "h")
        .mapInArrow(_count_hits(tasks), "part int, nodes array<bigint>, hits array<bigint>")
        .repartition(tasks, "part")
        .mapInArrow(_sum_hits, "node bigint, hits bigint")
    )
    alive = stored(
        classes.join(hits, "node").filter(F.col("hits") * 300 >= F.col("n") * threshold),
        "preselected",
    )
    ids = alive.select(F.col("rep").alias("alive_id"))
    chosen = docs.join(
        small_side(ids, ids.count()), F.col("doc_id").eqNullSafe(F.col("alive_id")), "left_semi"
    )
    sets = chosen.select("text").mapInArrow(_whole_sets, "node bigint, hashes array<bigint>")
    return stored(
        sets.join(alive.select("node", "n"), "node").dropDuplicates(["node"]), "candidate-sets"
    )


def _short_lists(sets: DataFrame, threshold: int) -> DataFrame:
    """(h, node, n, rare, hub): the members of short lists, for classes that may still have a partner.

    `rare` marks the lists that are merged in the search; `hub` is higher for a class whose
    shingles stand in longer lists, as those of a text that many others were copied from do.
    """
    posts = sets.select("node", "n", F.explode("hashes").alias("h"))
    lengths = posts.groupBy("h").agg(F.count("*").alias("length")).filter("length > 1")
    ordered = (
        posts.join(lengths, "h")
        .groupBy("node", "n")
        .agg(
            F.sort_array(F.collect_list(F.struct("length", "h"))).alias("lists"),
            (F.sum(F.log2("length")) / F.first("n")).alias("hub"),
        )
    )
    single = F.col("n") - F.size("lists")

    def first(apart: str) -> Column:
        """How many of the sorted lists remain when that many of a class's lists are set apart."""
        return F.greatest(F.col("n") - F.expr(apart) - single, F.lit(0)).cast("int")

    kept = ordered.filter(F.size("lists") >= _part(str(threshold))).select(
        "node",
        "n",
        "hub",
        first(_apart_share(threshold)).alias("rarest"),
        F.posexplode(F.slice("lists", F.lit(1), first(f"{threshold} * n div 200"))["h"]).alias("at", "h"),
    )
    return kept.select("h", "node", "n", (F.col("at") < F.col("rarest")).alias("rare"), "hub")


def _apart_share(threshold: int, n: str = "n") -> str:
    """How many of its longest lists a class of n shingles sets apart in the search."""
    return f"({APART} * {threshold} * {n}) div 10000"


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("h_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("h_b"))
    both = F.size(F.array_intersect("h_a", "h_b"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .filter(both * 100 >= (F.col("n_a") + F.col("n_b") - both) * threshold)
        .select("a", "b")
    )


def _stars(posts: DataFrame, sets: DataFrame, threshold: int, seed: int) -> DataFrame:
    """Links between classes and the leaders of most of their lists, in other components.

    `posts` has (h, node, n, hub, component). A list is led by its best hub and by the first
    members in orders that change with the seed.
    """
    orders = [F.struct((-F.col("hub")).alias("at"), "node", "n", "component")]
    orders += [
        F.struct(F.xxhash64(F.lit(seed), F.lit(k), "node").cast("double").alias("at"), "node", "n", "component")
        for k in range(LEADER_ORDERS - 1)
    ]
    lead = [F.min(order).alias(f"lead_{k}") for k, order in enumerate(orders)]
    leaders = posts.groupBy("h").agg(F.count("*").alias("m"), *lead).filter("m > 1")
    nodes = [F.struct(f"lead_{k}.node", f"lead_{k}.n", f"lead_{k}.component") for k in range(LEADER_ORDERS)]
    led = (
        posts.select("h", "node", "n", "component")
        .join(leaders, "h")
        .select("node", "n", "component", F.explode(F.array_distinct(F.array(*nodes))).alias("leader"))
        .filter(F.col("component") != F.col("leader.component"))
        .filter(similar_size(F.col("n"), F.col("leader.n"), threshold))
        .groupBy("node", F.col("leader.node").alias("to"))
        .count()
    )
    best = F.slice(F.sort_array(F.collect_list(F.struct("count", "to")), asc=False), 1, LEADERS)
    chosen = led.groupBy("node").agg(best.alias("best"))
    pairs = chosen.select(F.col("node").alias("a"), F.explode("best.to").alias("b"))
    return _verified(pairs, sets, threshold)


def _in_components(short: DataFrame, tied: DataFrame | None) -> DataFrame:
    """`short` with the component of each class, its own number while nothing ties it, and its members."""
    if tied is None:
        return short.withColumns({"component": F.col("node"), "members": F.lit(1).cast("bigint")})
    sizes = tied.groupBy("component").agg(F.count("*").alias("members"))
    known = tied.join(sizes, "component")
    return short.join(known, "node", "left").withColumns(
        {"component": F.coalesce("component", "node"), "members": F.coalesce("members", F.lit(1).cast("bigint"))}
    )


def _crossing(posts: DataFrame, threshold: int) -> DataFrame:
    """The postings in lists of several components, of classes with enough of them.

    A class meets a partner at least (t / 2) * |x| times in such lists.
    """
    for _ in range(2):
        lists = (
            posts.groupBy("h")
            .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo <> hi")
        )
        crossing = posts.join(lists.select("h"), "h")
        enough = (
            crossing.groupBy("node", "n").agg(F.count("*").alias("k")).filter(F.expr(f"k * 200 >= n * {threshold}"))
        )
        posts = stored(crossing.join(enough.select("node"), "node"), "crossing-lists")
    return posts


def _tie(short: DataFrame, sets: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, components, crossing postings): rounds of stars as long as they tie much.

    Later rounds compare what is still apart with other leaders. They spare the search, which finds whatever
    links they miss.
    """
    posts = _in_components(short, None)
    links = stored(_stars(posts, sets, threshold, 0), "stars")
    tied = stored(connected_components(links), "tied")
    posts = _crossing(_in_components(short, tied), threshold)
    open_before = posts.select("node").distinct().count()
    for seed in range(1, STAR_ROUNDS):
        if not open_before:
            break
        more = stored(_stars(posts, sets, threshold, seed), "stars")
        if not more.limit(1).count():
            break
        links = stored(links.unionByName(more), "links")
        tied = stored(connected_components(links), "tied")
        posts = _crossing(_in_components(posts.drop("component", "members"), tied), threshold)
        still = posts.select("node").distinct().count()
        if still * 10 > open_before * 9:
            break
        open_before = still
    return links, tied, posts


def _blocks(held: str) -> Column:
    return F.expr(f"cast(({held} + {BLOCK - 1}) div {BLOCK} as int)")


def _member() -> Column:
    return F.struct("node", "n", "k", "component", "members")


def _larger(members: Column, component: Column) -> Column:
    """Whether a component of that many members and that number comes after the row's own."""
    own = F.col("members")
    return (members > own) | ((members == own) & (component > F.col("component")))


def _merge_lists(threshold: int):
    """Count the occurrences of every partner over the lists of a class, which stand together."""
    apart = APART * threshold

    def partners(x: int, n: int, ys: list[np.ndarray], sizes: list[np.ndarray]):
        y, at, counts = np.unique(np.concatenate(ys), return_index=True, return_counts=True)
        m = np.concatenate(sizes)[at].astype(np.int64)
        total = -(-threshold * (n + m) // (100 + threshold))
        skipped = apart * np.maximum(n, m) // 10_000
        enough = counts >= total - skipped
        y, counts = y[enough], counts[enough]
        return pa.record_batch([pa.array(np.full(len(y), x)), pa.array(y), pa.array(counts)], ["a", "b", "met"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, size, ys, sizes = None, 0, [], []
        for b in batches:
            b_y, b_m = b["ys"], b["sizes"]
            for i, (x, n) in enumerate(zip(b["node"].to_pylist(), b["n"].to_pylist())):
                if x != current:
                    if ys:
                        yield partners(current, size, ys, sizes)
                    current, size, ys, sizes = x, n, [], []
                ys.append(b_y[i].values.to_numpy())
                sizes.append(b_m[i].values.to_numpy())
        if ys:
            yield partners(current, size, ys, sizes)

    return run


def _search(posts: DataFrame, threshold: int) -> DataFrame:
    """(a, b, met): classes of different components that meet in enough rare lists, and in how many.

    `posts` are the crossing postings; pairs that cannot meet often enough, by the lists
    that both have left, are dropped before anything is emitted for them.
    """
    posts = posts.filter("rare").select("h", "node", "n", "component", "members")
    lists = posts.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    left = posts.groupBy("node").agg(F.count("*").alias("k"))
    posts = stored(posts.join(lists.select("h"), "h").join(left, "node"), "rare-lists")
    # A component with BLOCK members in a list is a group of that list, all others make one.
    groups = posts.groupBy("h", "component").agg(F.count("*").alias("held"), F.max("members").alias("members"))
    heavy = stored(groups.filter(F.col("held") >= BLOCK).withColumn("blocks", _blocks("held")), "large-groups")
    if not heavy.limit(1).count():
        heavy = heavy.limit(0)  # known to be empty, so the plan leaves out its joins
    light = (
        groups.filter(F.col("held") < BLOCK)
        .groupBy("h")
        .agg(F.sum("held").alias("held"), F.max("members").alias("largest"))
        .withColumn("blocks", _blocks("held"))
    )
    of_heavy = heavy.select("h", "component", "held", F.col("blocks").alias("own_blocks"))
    total = posts.count()
    sides = join_uneven(posts, of_heavy, ["h", "component"], "held", total).select(
        "h", F.lit(True).alias("heavy"), F.col("component").alias("group"),
        F.pmod(F.xxhash64("node"), F.col("own_blocks")).cast("int").alias("block"), _member().alias("member"),
    )
    others = join_uneven(posts.join(of_heavy, ["h", "component"], "left_anti"), light, "h", "held", total).select(
        "h", F.lit(False).alias("heavy"), F.lit(0).cast("bigint").alias("group"),
        F.pmod(F.xxhash64("component"), F.col("blocks")).cast("int").alias("block"), _member().alias("member"),
    )
    key = ["h", "heavy", "group", "block"]
    members = sides.unionByName(others).groupBy(*key).agg(F.collect_list("member").alias("ys"))
    # A class looks into all groups of larger components; so a pair is met from one side in all lists.
    into_light = posts.join(light.select("h", "largest", "blocks"), "h").filter("largest >= members").drop("largest")
    into_light = into_light.withColumns({"heavy": F.lit(False), "group": F.lit(0).cast("bigint")})

    def least_met(n: Column, m: Column) -> Column:
        total = F.call_function("div", (n + m) * threshold + (99 + threshold), F.lit(100 + threshold))
        return total - F.call_function("div", F.greatest(n, m) * (APART * threshold), F.lit(10_000))

    # It looks into a large component only where the lists it shares with that suffice for some size there.
    spans = posts.groupBy("component").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    wide = heavy.join(spans, "component").select("h", F.col("component").alias("group"), F.col("members").alias("largest"), "blocks", "lo", "hi")
    lo = F.greatest("lo", _part(str(threshold)).cast("bigint"))
    hi = F.least("hi", F.expr(f"(n * 100) div {threshold}"))
    into_heavy = posts.join(wide, "h").filter(_larger(F.col("largest"), F.col("group"))).filter(lo <= hi)
    least = F.least(least_met(F.col("n"), lo), least_met(F.col("n"), hi))
    shared = into_heavy.groupBy("node", "group").agg(F.count("*").alias("shared"), F.max(least).alias("least"))
    into_heavy = (
        into_heavy.join(shared.filter("shared >= least").select("node", "group"), ["node", "group"])
        .select(*posts.columns, "blocks", F.lit(True).alias("heavy"), "group")
    )
    probes = into_light.select(*into_heavy.columns).unionByName(into_heavy).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )

    met = F.filter(
        "ys",
        lambda y: _larger(y["members"], y["component"])
        & similar_size(y["n"], F.col("n"), threshold)
        & (least_met(y["n"], F.col("n")) <= F.least(y["k"], F.col("k"))),
    )
    found = (
        probes.join(members, key)
        .select("node", "n", met.alias("met"))
        .filter(F.size("met") > 0)
        .select("node", "n", F.col("met.node").alias("ys"), F.col("met.n").cast("array<int>").alias("sizes"))
    )
    pairs = (
        found.repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(_merge_lists(threshold), "a bigint, b bigint, met bigint")
    )
    return stored(pairs, "partners")


def _apart(pairs: DataFrame, tied: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components, with these as low and high."""
    of_a = tied.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    of_b = tied.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    joined = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    c_a, c_b = F.coalesce("c_a", "a"), F.coalesce("c_b", "b")
    return joined.filter(c_a != c_b).select(
        "a", "b", "met", F.least(c_a, c_b).alias("low"), F.greatest(c_a, c_b).alias("high")
    )


def _links_between(
    pairs: DataFrame, stars: DataFrame, tied: DataFrame, sets: DataFrame, threshold: int
) -> DataFrame:
    """`stars` and enough links among `pairs` for the components of all of them.

    The pair of most occurrences of every two components is probed first. That ties most
    components that belong together, and only pairs still apart are probed after it.
    """
    first = (
        _apart(pairs, tied)
        .groupBy("low", "high")
        .agg(F.max(F.struct("met", "a", "b")).alias("best"))
        .select("best.a", "best.b")
    )
    links = stored(stars.unionByName(_verified(first, sets, threshold)), "links")
    rest = _apart(pairs, stored(connected_components(links), "tied"))
    return links.unionByName(_verified(rest, sets, threshold))


def link_documents(docs: DataFrame, *, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, text_hash) of every document.

    component_id is the smallest doc_id that links reach; class_id is shared by equal sets.
    """
    return _linked(docs, threshold).drop("component")


def _linked(docs: DataFrame, threshold: int) -> DataFrame:
    """The columns of link_documents, and `component`: a node of the component, null without words.

    Components that hold null doc_ids only, or the same smallest doc_id, share a component_id.
    """
    python_tasks(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = stored(
        docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
            _sized, f"doc_id {kind}, text_hash bigint, node bigint, n bigint"
        ),
        "shingle-sets",
    )
    classes = stored(
        sized.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")),
        "shingle-classes",
    )
    sets = _candidate_sets(docs, classes, threshold)
    short = stored(_short_lists(sets, threshold), "short-lists")
    stars, tied, crossing = _tie(short, sets, threshold)
    links = _links_between(_search(crossing, threshold), stars, tied, sets, threshold)
    found = stored(connected_components(links), "components")
    joined = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = joined.join(smallest, "component").select("node", "component_id", "component")
    empty = F.col("n") == 0
    return sized.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("node").alias("class_id"),
        "text_hash",
        "component",
    )


def keep_one(docs: DataFrame, *, threshold: int = THRESHOLD) -> DataFrame:
    """`docs` with one row of each component: that with the smallest doc_id (then text hash).

    Documents without words are kept.
    """
    linked = stored(_linked(docs, threshold).filter("n_shingles > 0"), "linked")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    first = linked.groupBy("component").agg(F.min(row).alias("kept"))
    marked = linked.join(first, "component").select(
        "doc_id",
        "text_hash",
        (F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_hash") == F.col("kept.text_hash"))).alias(
            "keeper"
        ),
    )
    marked = stored(
        marked.groupBy("doc_id", "text_hash").agg(F.max("keeper").alias("keeper"), F.count("*").alias("rows")),
        "near-copies",
    )
    own_id, own_hash = free_names(docs, "id", "hash")
    named = [F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)]
    key = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash))
    drop = marked.filter(~F.col("keeper")).select(*named)
    kept = docs.join(small_side(drop, drop.count()), key, "left_anti")
    repeated = marked.filter("keeper and rows > 1").select(*named)
    n = repeated.count()
    if not n:
        return kept
    again = small_side(repeated, n)
    whole = kept.join(again, key, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, key, "left_anti").unionByName(whole)
