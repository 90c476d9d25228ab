"""Near-duplicate embeddings: links of equal label found by search in a pruned graph.

Method. Vectors of one label are parted into overlapping cluster shards: pivots are
sampled, none within the link threshold of another, and every vector goes to its nearest
ones; near a pivot it goes to every cell from whose border it is at most half the
threshold's angle away, so that linked vectors on two sides of a border share a cell. Shards
still too large are parted again, as long as that saves comparisons. In each shard a flat
graph is built by robust pruning: of the nearest candidates, one that is much nearer to a
chosen neighbour than to the vector itself is left out. A vector's adjacency lists of all
its shards are united. Then every vector searches each of its shards: greedily from the shard's medoid to
the best unexpanded vector, and as soon as vectors are within the threshold, from all of
them, until none in range is left. A found pair is a link only if its cosine in double
precision reaches the threshold; a pair that meets in several shards counts in the first.
An audit compares a bounded set of vectors with all others and stops the run if the recall
is too low.

Hot groups. Equal vectors are one node with a weight. A group of near copies that pivots
cannot part, or only with too many copies, is dealt into blocks by a hash; blocks build
their own graphs and each pair of blocks is searched, so links across blocks are found and
no task holds the whole group. A task returns counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import batches_of, components, forest, over_batches, record_batch
from lakeloom.session import materialize

SHARD = 1024  # nodes of a block, about; larger shards are parted
PER_PIVOT = 128  # a shard gets a pivot for so many members, ``PIVOTS`` at most
PIVOTS = 256
OVERLAP = 3
PROBES = 4  # members drawn for every pivot, to tell what parting would cost
WORTH = 0.75  # parts only if the squared sizes of the parts add up to this share of the whole's
CANDIDATES, DEGREE, ALPHA = 96, 24, 1.2
LONG_LINKS = 8  # seeded random neighbours, without which a large group of copies is an island
EXPANSIONS, BEAM = 24, 4  # nodes out of range that a search expands, and at a time
QUERIES_AT_ONCE = 128
MAX_LEVELS = 12


def units(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """``vec_id, space, key, unit``: unit vectors as little-endian doubles.

    ``space`` is the label and the number of components; ``key`` identifies equal unit
    vectors of a space. All three are null where a vector links with nothing.
    """
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )

    def run(batches):
        for batch in batches_of(batches):
            found, spaces = [], []
            for vec_id, label_, values in zip(*[c.to_pylist() for c in batch.columns]):
                unit = None
                if vec_id is not None and label_ is not None and values and None not in values:
                    x = np.array(values, np.float64)
                    top = np.abs(x).max()
                    if np.isfinite(top) and top > 0:
                        x = x / top  # so that squares neither overflow nor vanish
                        unit = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
                found.append(unit)
                spaces.append(None if unit is None else f"{len(values)}:{label_}")
            yield record_batch(
                {
                    "vec_id": (batch.column("vec_id"), pa.int64()),
                    "space": (spaces, pa.string()),
                    "unit": (found, pa.binary()),
                }
            )

    made = over_batches(rows, run, "vec_id bigint, space string, unit binary")
    key = F.md5(F.concat(F.col("space").cast("binary"), F.lit(b"\0"), F.col("unit")))
    return made.select("vec_id", "space", key.alias("key"), "unit")


def matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def grouped(batches, keys: list[str]):
    """Tables of equal keys from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches_of(batches):
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        cuts = [0, *[i for i in range(1, len(rows)) if rows[i] != rows[i - 1]], len(rows)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and rows[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = rows[a]
    if held:
        yield last, pa.Table.from_batches(held)


# --- shards ------------------------------------------------------------------------


def part_once(members: DataFrame, sizes: DataFrame, level: int, threshold: float) -> DataFrame:
    """Members of large shards, each in the shards of its nearest pivots.

    A shard's pivots and members meet in tasks of bounded size: members are salted by a hash
    and the few pivots and probes are copied to every salt.
    """
    large = sizes.select(
        "shard",
        F.greatest(F.lit(PER_PIVOT), (F.col("n") / PIVOTS).cast("int")).alias("every"),
        F.ceil(F.col("n") / (64 * SHARD)).cast("int").alias("salts"),
    )
    hashed = F.xxhash64(F.col("cid"), F.lit(level))
    rows = members.join(large, "shard")
    drawn = F.pmod(hashed, "every")  # 0: a pivot, up to ``PROBES``: a probe
    pivots = rows.where(drawn <= PROBES).select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.least(drawn, F.lit(1)).cast("int").alias("role"),
        "cid",
        "unit",
    )
    dealt = rows.select(
        "shard",
        F.pmod(F.xxhash64(F.lit("salt"), F.col("cid")), "salts").cast("int").alias("salt"),
        F.lit(2).alias("role"),
        "cid",
        "unit",
    )

    def run(batches):
        current, pivots, probes, block = None, [], [], None
        for batch in batches_of(batches):
            ids = batch.column("cid").to_numpy()
            roles = batch.column("role").to_numpy()
            keys = list(zip(batch.column("shard").to_pylist(), batch.column("salt").to_pylist()))
            data = matrix_rows(batch.column("unit"))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if keys[a] != current:
                    current, pivots, probes, block = keys[a], [], [], None
                first, middle = a + np.searchsorted(roles[a:b], [1, 2])
                pivots += data[a:first]
                probes += data[first:middle]
                if middle == b:
                    continue
                x = np.array(data[middle:b])
                if block is None:
                    block = apart(np.array(pivots).reshape(len(pivots), x.shape[1]), threshold)
                    if len(block) > 1 and not worth_parting(np.array(probes), block, threshold):
                        block = block[:1]
                yield assigned(current[0], ids[middle:b], x, block, threshold)

    def matrix_rows(column):
        return [np.frombuffer(v, "<f8") for v in column.to_pylist()]

    together = (
        pivots.unionByName(dealt)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", "salt", "role", "cid")
    )
    return over_batches(together, run, "cid bigint, shard string, unit binary, parted boolean")


def apart(pivots: np.ndarray, threshold: float) -> np.ndarray:
    """The pivots, in order, that are not within the threshold of an earlier one."""
    kept: list[int] = []
    for i in range(len(pivots)):
        if not kept or (pivots[kept] @ pivots[i]).max() < threshold:
            kept.append(i)
    return pivots[kept]


def cells(x: np.ndarray, pivots: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pivots' cells (columns) hold each member (rows).

    The way from a member to a linked one in another cell crosses the border, the plane
    between the two pivots, and one of the two is at most half the threshold's angle from
    it. That one goes to the other's cell as well. This holds for members within twice the
    threshold's angle of a pivot, so for all links of a member within the threshold of one;
    members with no pivot that near go to the ``OVERLAP`` nearest.
    """
    angle = np.arccos(np.clip(threshold, -1, 1))
    cosine = x @ pivots.T
    nearest = cosine.argmax(axis=1)
    top = cosine.max(axis=1)
    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[nearest]
    slack = 1e-9  # a cell more does no harm
    held = top[:, None] - cosine <= np.sin(angle / 2) * between + slack
    held &= cosine >= np.cos(min(3 * angle, np.pi)) - slack
    held &= top[:, None] >= np.cos(min(2 * angle, np.pi)) - slack
    held[np.arange(len(x)), nearest] = True
    far = np.flatnonzero(top < threshold)
    best = np.argsort(-cosine[far], axis=1, kind="stable")[:, :OVERLAP]
    held[far[:, None], best] = True
    return held


def worth_parting(probes: np.ndarray, pivots: np.ndarray, threshold: float) -> bool:
    """Whether the cells, overlaps and all, hold fewer pairs than the shard does."""
    if not len(probes):
        return True
    share = cells(probes, pivots, threshold).mean(axis=0)
    return float(share @ share) <= WORTH


def assigned(
    shard: str, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, threshold: float
) -> pa.RecordBatch:
    """Members in the shards of the cells that hold them."""
    if len(pivots) < 2:  # one: nothing parts this shard; none: the next level draws again
        names, rows, parted = [shard] * len(ids), np.arange(len(ids)), len(pivots) == 0
    else:
        rows, place = np.nonzero(cells(x, pivots, threshold))
        names = [f"{shard}/{p}" for p in place.tolist()]
        parted = True
    return record_batch(
        {
            "cid": (ids[rows], pa.int64()),
            "shard": (names, pa.string()),
            "unit": ([x[i].tobytes() for i in rows], pa.binary()),
            "parted": ([parted] * len(names), pa.bool_()),
        }
    )


def shards(classes: DataFrame, threshold: float) -> DataFrame:
    """``cid, shard, block, blocks, unit``: every node in all its shards."""
    left = classes.select("cid", F.col("space").alias("shard"), "unit")
    done: list[DataFrame] = []
    for level in range(MAX_LEVELS):
        sizes = materialize(left.groupBy("shard").agg(F.count("*").alias("n")), "sizes")
        large = sizes.where(F.col("n") > SHARD)
        if large.isEmpty():
            break
        done.append(left.join(large, "shard", "left_anti"))
        made = materialize(
            part_once(left.join(large.select("shard"), "shard"), large, level, threshold), "parted"
        )
        done.append(made.where("not parted").drop("parted"))
        left = made.where("parted").drop("parted")
    done.append(left)
    members = done[0].select("cid", "shard", "unit")
    for more in done[1:]:
        members = members.unionByName(more.select("cid", "shard", "unit"))
    blocks = members.groupBy("shard").agg(
        F.ceil(F.count("*") / SHARD).cast("int").alias("blocks")
    )
    return members.join(blocks, "shard").select(
        "cid",
        "shard",
        F.pmod(F.xxhash64(F.lit("block"), F.col("cid")), "blocks").cast("int").alias("block"),
        "blocks",
        "unit",
    )


# --- graphs ------------------------------------------------------------------------


def robust_prune(x: np.ndarray) -> np.ndarray:
    """Neighbours of each row (-1: none), pruned so that directions differ."""
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1)
    cosine = x @ x.T
    np.fill_diagonal(cosine, -np.inf)
    wide = min(CANDIDATES, n - 1)
    candidate = np.argpartition(-cosine, wide - 1, axis=1)[:, :wide]
    rows = np.arange(n)[:, None]
    order = np.argsort(-cosine[rows, candidate], axis=1, kind="stable")
    candidate = candidate[rows, order]
    far = np.sqrt(np.maximum(2 - 2 * cosine[rows, candidate], 0))  # distance to the row itself
    alive = np.ones(candidate.shape, bool)
    chosen = np.full((n, min(DEGREE, wide)), -1)
    for k in range(chosen.shape[1]):
        some = np.flatnonzero(alive.any(axis=1))
        if not len(some):
            break
        first = alive[some].argmax(axis=1)
        pick = candidate[some, first]
        chosen[some, k] = pick
        between = np.sqrt(np.maximum(2 - 2 * cosine[pick[:, None], candidate[some]], 0))
        alive[some] &= ALPHA * between > far[some]
        alive[some, first] = False
    # A few differing neighbours at random keep the groups of near copies connected.
    hops = np.random.default_rng(n).integers(1, n, LONG_LINKS)
    return np.c_[chosen, (rows + hops) % n]


def adjacency(members: DataFrame) -> DataFrame:
    """``cid, near``: each node's neighbours, united over its shards."""

    def run(batches):
        for _, rows in grouped(batches, ["shard", "block"]):
            rows = rows.combine_chunks()
            ids = rows.column("cid").to_numpy()
            found = robust_prune(matrix(rows.column("unit")))
            there = found >= 0
            near = np.split(ids[found[there]], np.cumsum(there.sum(axis=1))[:-1])
            yield record_batch(
                {"cid": (ids, pa.int64()), "near": (near, pa.list_(pa.int64()))}
            )

    ordered = members.repartition("shard", "block").sortWithinPartitions("shard", "block", "cid")
    lists = over_batches(ordered, run, "cid bigint, near array<bigint>")
    # A node has a few shards, and a list of bounded length in each.
    return lists.groupBy("cid").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    )


# --- search ------------------------------------------------------------------------


def local_graph(ids: np.ndarray, near: list) -> np.ndarray:
    """Adjacency by place, both ways, without neighbours that are not here."""
    flat = np.concatenate([np.array(n, np.int64) for n in near] or [np.empty(0, np.int64)])
    source = np.repeat(np.arange(len(ids)), [len(n) for n in near])
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids[order], flat), len(ids) - 1)
    here = ids[order][at] == flat
    a, b = source[here], order[at[here]]
    edges = np.unique(np.r_[a * len(ids) + b, b * len(ids) + a])
    a, b = edges // len(ids), edges % len(ids)
    degree = np.bincount(a, minlength=len(ids))
    table = np.full((len(ids), max(1, int(degree.max(initial=0)))), -1)
    table[a, np.arange(len(a)) - (np.cumsum(degree) - degree)[a]] = b
    return table


def search(
    x: np.ndarray, graph: np.ndarray, queries: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs within the threshold, by range-expanding greedy search."""
    center = x.sum(axis=0)
    medoid = int((x @ center).argmax())
    left, right = [], []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        q = queries[at : at + QUERIES_AT_ONCE]
        seen = np.full((len(q), len(x)), -np.inf)
        seen[:, medoid] = q @ x[medoid]
        open_ = np.full(seen.shape, -np.inf)  # the unexpanded ones
        open_[:, medoid] = seen[:, medoid]
        expanded = np.zeros(len(q), np.int64)
        while True:
            front = open_ >= threshold
            more = np.flatnonzero((expanded < EXPANSIONS) & ~front.any(axis=1))
            if len(more):
                beam = min(BEAM, len(x))
                best = np.argpartition(-open_[more], beam - 1, axis=1)[:, :beam]
                front[more[:, None], best] = open_[more[:, None], best] > -np.inf
            qi, ni = np.nonzero(front)
            if not len(qi):
                break
            open_[qi, ni] = -np.inf
            expanded += front.sum(axis=1)
            fresh = np.zeros(seen.shape, bool)
            near = graph[ni]
            there = near >= 0
            fresh[np.repeat(qi, there.sum(axis=1)), near[there]] = True
            fresh &= seen == -np.inf
            qi, ni = np.nonzero(fresh)
            for k in range(0, len(qi), 1 << 16):
                some = slice(k, k + (1 << 16))
                value = np.einsum("ij,ij->i", q[qi[some]], x[ni[some]])
                seen[qi[some], ni[some]] = value
                open_[qi[some], ni[some]] = value
        qi, ni = np.nonzero(seen >= threshold)
        left.append(qi + at)
        right.append(ni)
    return np.concatenate(left), np.concatenate(right)


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that rows of both have (rows hold equal padding apart)."""
    top = np.iinfo(np.int64).max
    best = np.full(len(a), top)
    for k in range(a.shape[1]):
        shared = (a[:, k, None] == b).any(axis=1)
        best = np.minimum(best, np.where(shared, a[:, k], top))
    return best


def links(members: DataFrame, near: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """``cid, root, links``: partial link counts, and a forest that connects linked nodes."""
    number = F.xxhash64("shard")
    # The collected list is as long as a node has shards.
    all_shards = members.groupBy("cid").agg(F.collect_list(number).alias("shards"))
    nodes = materialize(
        members.join(near, "cid").join(all_shards, "cid").join(weights, "cid"), "nodes"
    )
    pairs = F.sequence(F.lit(0), F.col("block"))
    base = ["cid", "shard", "unit", "near", "shards", "weight"]
    as_nodes = nodes.select(
        *base, F.explode(pairs).alias("left"), F.col("block").alias("right"), F.lit(1).alias("role")
    )
    as_queries = (
        nodes.where("block + 1 < blocks")
        .withColumn("near", F.array().cast("array<bigint>"))
        .select(
            *base,
            F.col("block").alias("left"),
            F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("right"),
            F.lit(0).alias("role"),
        )
    )
    together = (
        as_nodes.unionByName(as_queries)
        .withColumn("number", number)
        .repartition("shard", "left", "right")
        .sortWithinPartitions("shard", "left", "right", "role", "cid")
    )

    def run(batches):
        for (_, block, other), rows in grouped(batches, ["shard", "left", "right"]):
            rows = rows.combine_chunks()
            ids = rows.column("cid").to_numpy()
            role = rows.column("role").to_numpy()
            weight = rows.column("weight").to_numpy()
            x = matrix(rows.column("unit"))
            lists = rows.column("shards").to_pylist()
            widest = max(map(len, lists))
            homes = np.array([s + [s[0]] * (widest - len(s)) for s in lists], np.int64)
            own = np.flatnonzero(role == 1)
            asked = own if block == other else np.flatnonzero(role == 0)
            if not len(own) or not len(asked):
                continue
            near = rows.column("near").take(pa.array(own)).to_pylist()
            a, b = search(x[own], local_graph(ids[own], near), x[asked], threshold)
            a, b = asked[a], own[b]
            if block == other:  # found from either side
                a, b = np.minimum(a, b), np.maximum(a, b)
                both = np.unique((a * len(ids) + b)[a != b])
                a, b = both // len(ids), both % len(ids)
            here = rows.column("number")[0].as_py()
            first = np.concatenate(
                [np.empty(0, np.int64)]
                + [
                    first_shared(homes[a[k : k + 65536]], homes[b[k : k + 65536]])
                    for k in range(0, len(a), 65536)
                ]
            )
            a, b = a[first == here], b[first == here]
            if not len(a):
                continue
            count = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
            child, root = forest(ids[a], ids[b])
            known = dict(zip(child.tolist(), root.tolist()))
            linked = np.flatnonzero(count)
            yield record_batch(
                {
                    "cid": (ids[linked], pa.int64()),
                    "root": ([known.get(i, i) for i in ids[linked].tolist()], pa.int64()),
                    "links": (count[linked].astype(np.int64), pa.int64()),
                }
            )

    return over_batches(together, run, "cid bigint, root bigint, links bigint")


# --- the operator ------------------------------------------------------------------


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    audit_vectors: int = 256,
    min_recall: float = 0.9,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors link if their labels are equal and their cosine reaches the threshold.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable by links, ``kept`` tells whether that is the row's own. Rows with a null
    id, label, vector or component, with a zero or non-finite component vector, or without
    components link with nothing (a null id is not kept); vectors of different length never
    link. Rows that repeat an id are vectors of their own, each with its own links; equal
    vectors link. Other columns are ignored.
    """
    rows = materialize(units(vectors, id_column, vector, label), "units")
    classes = materialize(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.count("*").alias("weight"),
            F.min("space").alias("space"),
            F.min("unit").alias("unit"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    weights = classes.select("cid", "weight")
    members = materialize(shards(classes, threshold), "shards")
    found = materialize(links(members, adjacency(members), weights, threshold), "found")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("cid").alias("a"), F.col("root").alias("b"))
    roots = components(edges).withColumnRenamed("node", "cid")
    named = classes.select("cid", "key", "first_id", "weight").join(roots, "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_class = (
        named.join(lowest, "root")
        .join(counts, "cid", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            "component_id",
        )
    )
    result = (
        rows.drop("unit", "space")
        .join(per_class, "key", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
    if audit_vectors:
        share = audit(classes, counts, threshold, audit_vectors)
        if share < min_recall:
            raise RuntimeError(f"only {share:.1%} of the audited links were found")
    return result


def audit(classes: DataFrame, counts: DataFrame, threshold: float, n: int = 256) -> float:
    """Recall of links between different vectors, for ``n`` nodes against all others.

    The nodes are those with the smallest hashes; they and their counts are the only thing
    that goes through the driver.
    """
    chosen = (
        classes.select("cid", "space", "unit")
        .orderBy(F.xxhash64(F.lit("audit"), F.col("cid")), "cid")
        .limit(n)
        .join(counts, "cid", "left")
        .collect()
    )
    if not chosen:
        return 1.0
    by_space: dict[str, list] = {}
    for r in chosen:
        by_space.setdefault(r.space, []).append((r.cid, r.unit))

    def run(batches):
        asked = {
            s: (np.array([i for i, _ in v]), np.array([np.frombuffer(u, "<f8") for _, u in v]))
            for s, v in by_space.items()
        }
        for batch in batches_of(batches):
            spaces = np.array(batch.column("space").to_pylist(), object)
            for space in set(spaces) & asked.keys():
                at = np.flatnonzero(spaces == space)
                x = matrix(batch.column("unit").take(pa.array(at)))
                own = batch.column("cid").to_numpy()[at]
                weight = batch.column("weight").to_numpy()[at]
                ids, queries = asked[space]
                near = (queries @ x.T >= threshold) & (ids[:, None] != own[None, :])
                yield record_batch(
                    {"cid": (ids, pa.int64()), "links": ((near * weight).sum(axis=1), pa.int64())}
                )

    exact = (
        over_batches(
            classes.select("cid", "space", "unit", "weight"), run, "cid bigint, links bigint"
        )
        .groupBy("cid")
        .agg(F.sum("links").alias("links"))
        .collect()
    )
    want = {r.cid: r.links for r in exact}
    total = sum(want.values())
    got = sum(min(r.links or 0, want.get(r.cid, 0)) for r in chosen)
    return got / total if total else 1.0
