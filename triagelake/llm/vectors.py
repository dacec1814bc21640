"""Near-duplicate embeddings on a robust-pruned flat graph.

Equal vectors are one node. Centroids are fitted on a bounded sample, and every node
goes to the shards of its ``overlap`` nearest centroids; a shard of more than ``BLOCK``
nodes is cut in blocks. In each block every node gets neighbours by robust pruning of
its nearest nodes and some far ones, with the reverse edges; the adjacency lists of a
node from all its shards are united to one flat graph. A node is then looked for in
all blocks of its shards: greedy beam search from the block's medoids, then range
expansion over every node in reach; a sweep over the block adds what the search has
missed, so all shards that both ends share find a pair. Pairs are verified in double
precision, and counted in the first of these shards. What leaves a task is a row per
node (its links and the smallest node of its component there), never the pairs.
Recall, averaged over nodes, is audited against brute force until ``AUDITED`` nodes with
links are met or the last of ``AUDIT_SIZES`` nodes are looked at; without a linked node
among these it is null. While it is below ``LEAST_RECALL``, the overlap is doubled; past
``MOST_OVERLAP`` all nodes are one shard, whose blocks all meet.

Vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are their own component; shorter vectors count as filled up with zeros;
rows with equal ids are vectors of their own; a null id is a component's id only if
there is no other. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.spread import components
from triagelake.session import materialise, ship_package

LEAST_COSINE = 0.95
#: Vectors that centroids are fitted on, and centroids, at most.
SAMPLE, MOST_CENTROIDS = 20_000, 4096
SHARD, BLOCK, OVERLAP, MOST_OVERLAP = 1200, 2000, 3, 12
NEAREST, FAR, DEGREE, REVERSE, ALPHA = 48, 16, 16, 32, 1.2
BEAM, STARTS = 24, 12
#: Range expansion steps over nodes this much below the least cosine, too.
MARGIN = 0.08
#: Queries that are searched together, and pairs that are expanded together.
AT_ONCE, PAIRS_AT_ONCE = 256, 8192
AUDITED, LEAST_RECALL = 200, 0.95
#: Nodes that an audit looks at, as long as too few of them have links.
AUDIT_SIZES = (1000, 5000, 20_000)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Normalised rows in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    out /= np.abs(out).max(axis=1, keepdims=True)  # squares of very large or small components
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        order = np.argsort(own, kind="stable")
        held, first = np.unique(own[order], return_index=True)
        c = c.copy()
        c[held] = np.add.reduceat(x[order], first, axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1), 1e-12)[:, None]
    return c


# -- the graph of a block ---------------------------------------------------------------


def robust_pruned(x: np.ndarray, seed: int) -> np.ndarray:
    """(n, up to DEGREE) neighbours, -1 where there are fewer: of the candidates by
    distance, the nearest stays and strikes those that it is ALPHA times nearer to."""
    n = len(x)
    near = (x @ x.T).astype(np.float32)
    np.fill_diagonal(near, -2)
    k = min(NEAREST, n - 1)
    if k < 1:
        return np.full((n, 1), -1)
    nearest = np.argpartition(-near, k - 1, axis=1)[:, :k]
    rng = np.random.default_rng(seed)
    pool = np.concatenate([nearest, rng.integers(0, n, (n, FAR))], axis=1)
    own = np.arange(n)[:, None]
    pool = np.take_along_axis(pool, np.argsort(-near[own, pool], axis=1, kind="stable"), axis=1)
    distance = np.sqrt(np.maximum(2 - 2 * near[own, pool], 0))
    alive = pool != own
    out = np.full((n, DEGREE), -1)
    rows = np.arange(n)
    for r in range(DEGREE):
        first = np.argmax(alive, axis=1)
        some = alive[rows, first]
        star = pool[rows, first]
        out[some, r] = star[some]
        between = np.sqrt(np.maximum(2 - 2 * near[star[:, None], pool], 0))
        between[star[:, None] == pool] = 0
        alive &= (ALPHA * between > distance) & some[:, None]
        alive[rows, first] = False
    return out


def with_reverse(adjacency: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges as (from, to), each once: those given and, of a node's reverse ones, the
    ``REVERSE`` nearest (a hub would have one to nearly all)."""
    a, r = np.nonzero(adjacency >= 0)
    b = adjacency[a, r]
    near = np.einsum("ij,ij->i", x[a], x[b])
    order = np.lexsort((-near, b))
    start = np.searchsorted(b[order], np.arange(len(x)))
    back = order[np.arange(len(order)) - start[b[order]] < REVERSE]
    pairs = np.unique(np.concatenate([a * len(x) + b, b[back] * len(x) + a[back]]))
    return pairs // len(x), pairs % len(x)


def table_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Edges (ordered by from) as a padded adjacency table."""
    degree = np.bincount(a, minlength=n)
    out = np.full((n, max(1, int(degree.max(initial=0)))), -1)
    out[a, np.arange(len(a)) - np.repeat(np.cumsum(degree) - degree, degree)] = b
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """The node nearest to the mean, then those furthest from all picked before."""
    picked = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[picked[0]]
    while len(picked) < min(STARTS, len(x)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picked[-1]])
    return np.array(picked)


def range_search(x: np.ndarray, adjacency: np.ndarray, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with a cosine of ``least`` or more that the search finds."""
    parts = [(a, *_range_search(x, adjacency, q[a:a + AT_ONCE], least)) for a in range(0, len(q), AT_ONCE)]
    return np.concatenate([a + i for a, i, _ in parts]), np.concatenate([j for _, _, j in parts])


def _range_search(x: np.ndarray, adjacency: np.ndarray, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    x32, q32, m = x.astype(np.float32), q.astype(np.float32), len(q)
    starts = medoids(x)
    seen = np.zeros((m, len(x)), bool)
    seen[:, starts] = True
    ids = np.tile(starts, (m, 1))
    sims = q32 @ x32[starts].T
    done = np.zeros(ids.shape, bool)
    reached = [(np.repeat(np.arange(m), len(starts)), ids.ravel(), sims.ravel())]
    active = np.arange(m)
    while len(active):
        rank = np.where(done[active], -3, sims[active])
        at = np.argmax(rank, axis=1)
        go = rank[np.arange(len(active)), at] > -3
        active, at = active[go], at[go]
        done[active, at] = True
        found = adjacency[ids[active, at]]
        new = (found >= 0) & ~seen[active[:, None], found]
        i, r = np.nonzero(new)
        value = np.full(found.shape, -3, np.float32)
        value[i, r] = np.einsum("ij,ij->i", x32[found[i, r]], q32[active[i]])
        seen[active[i], found[i, r]] = True
        reached.append((active[i], found[i, r], value[i, r]))
        ids_new, sims_new = np.full((m, BEAM), -1), np.full((m, BEAM), -3, np.float32)
        done_new = np.ones((m, BEAM), bool)
        all_ids = np.concatenate([ids[active], found], axis=1)
        all_sims = np.concatenate([sims[active], value], axis=1)
        all_done = np.concatenate([done[active], ~new], axis=1)
        width = min(BEAM, all_ids.shape[1])
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids_new[active, :width] = np.take_along_axis(all_ids, best, axis=1)
        sims_new[active, :width] = np.take_along_axis(all_sims, best, axis=1)
        done_new[active, :width] = np.take_along_axis(all_done, best, axis=1)
        ids, sims, done = ids_new, sims_new, done_new
    i, j, s = (np.concatenate(c) for c in zip(*reached))
    close = s >= least - MARGIN
    i, j = i[close], j[close]
    pairs, frontier = [(i, j)], [(i, j)]
    while frontier:  # expansion: the neighbours of all that is in reach, until nothing new is
        i, j = frontier.pop()
        if len(i) > PAIRS_AT_ONCE:
            frontier += [(i[PAIRS_AT_ONCE:], j[PAIRS_AT_ONCE:])]
            i, j = i[:PAIRS_AT_ONCE], j[:PAIRS_AT_ONCE]
        found = adjacency[j]
        a, r = np.nonzero(found >= 0)
        new = ~seen[i[a], found[a, r]]
        key = np.unique(i[a[new]] * len(x) + found[a[new], r[new]])
        i, j = key // len(x), key % len(x)
        seen[i, j] = True
        close = np.einsum("ij,ij->i", x32[j], q32[i]) >= least - MARGIN
        if close.any():
            pairs.append((i[close], j[close]))
            frontier.append(pairs[-1])
    i, j = (np.concatenate(c) for c in zip(*pairs))
    exact = np.concatenate([np.einsum("ij,ij->i", q[i[a:a + 16384]], x[j[a:a + 16384]]) for a in range(0, len(i), 16384)] or [np.zeros(0)])
    return i[exact >= least], j[exact >= least]


def swept(x: np.ndarray, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (query, node) with a cosine of ``least`` or more, verified as the search does."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a in range(0, len(q), AT_ONCE):
        i, j = np.nonzero(q[a:a + AT_ONCE] @ x.T >= least - 1e-9)
        for b in range(0, len(i), 16384):
            u, v = i[b:b + 16384] + a, j[b:b + 16384]
            fine = np.einsum("ij,ij->i", q[u], x[v]) >= least
            out.append((u[fine], v[fine]))
    i, j = (np.concatenate(c) for c in zip(*out))
    return i, j


# -- the jobs ---------------------------------------------------------------------------


def _assigned(nodes: DataFrame, dim: int, overlap: int) -> tuple[DataFrame, int]:
    """(node, copies, embedding, shards): shards ascending; no overlap means one shard."""
    n = nodes.count()
    k = int(min(MOST_CENTROIDS, max(1, -(-n * overlap // SHARD))))
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(max(1, n // SAMPLE))) == 0).select("embedding").limit(SAMPLE).toArrow()
    centroids = fit_centroids(matrix(sample["embedding"], dim), k) if n and sample.num_rows else np.zeros((1, dim))
    width = min(max(1, overlap), len(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = matrix(batch.column("embedding"), dim) @ centroids.T
                shards = np.sort(np.argpartition(-near, width - 1, axis=1)[:, :width].astype(np.int32), axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(shards), pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"])

    return materialise(nodes.mapInArrow(run, "node bigint, copies bigint, embedding array<float>, shards array<int>"), "assigned"), k


def _links(nodes: DataFrame, dim: int, overlap: int, least: float) -> DataFrame:
    """(node, links, root): per node and block it was looked for in."""
    assigned, _ = _assigned(nodes, dim, overlap)
    members = assigned.withColumn("shard", F.explode("shards"))
    blocks = F.broadcast(members.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))  # MOST_CENTROIDS rows at most
    members = members.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        x, node = matrix(table["embedding"], dim), table["node"].to_numpy()
        a, b = with_reverse(robust_pruned(x, int(table["shard"][0].as_py())), x)
        lists = np.split(node[b], np.cumsum(np.bincount(a, minlength=len(node)))[:-1])
        return pa.table([table["node"], pa.array([v.tolist() for v in lists], pa.list_(pa.int64()))], names=["node", "neighbours"])

    built = members.select("shard", "block", "node", "embedding").groupBy("shard", "block").applyInArrow(build, "node bigint, neighbours array<bigint>")
    # united over the shards of a node: overlap lists at most
    graph = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    searched = members.join(graph, "node").withColumn("asked", every).select(
        "shard", "block", "asked", F.lit(False).alias("query"), "node", "copies", "embedding", "shards", "neighbours")
    asked = members.withColumn("asked", F.col("block")).withColumn("block", every).select(
        "shard", "block", "asked", F.lit(True).alias("query"), "node", "copies", "embedding", "shards", F.lit(None).cast("array<bigint>").alias("neighbours"))

    def search(table: pa.Table) -> pa.Table:
        index, query = (table.filter(pc.equal(table["query"], v)) for v in (False, True))
        x, q = matrix(index["embedding"], dim), matrix(query["embedding"], dim)
        node, ask = index["node"].to_numpy(), query["node"].to_numpy()
        order = np.argsort(node)
        lists = index["neighbours"].combine_chunks()
        a, b = np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
        at = order[np.minimum(np.searchsorted(node[order], b), len(node) - 1)]
        here = node[at] == b
        i, j = range_search(x, table_of(a[here], at[here], len(node)), q, least)
        more = swept(x, q, least)
        key = np.unique(np.concatenate([i * len(node) + j, more[0] * len(node) + more[1]]))
        i, j = key // len(node), key % len(node)
        other = ask[i] != node[j]
        i, j = i[other], j[other]
        shared = np.stack(query["shards"].to_pylist())[i][:, :, None] == np.stack(index["shards"].to_pylist())[j][:, None, :]
        first = np.where(shared.any(axis=2), np.stack(query["shards"].to_pylist())[i], np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max)
        here = first == table["shard"][0].as_py()
        links = np.bincount(i[here], weights=index["copies"].to_numpy()[j[here]], minlength=len(ask)).astype(np.int64)
        # the smallest node of each query's component in this block
        names, place = np.unique(np.concatenate([ask, node]), return_inverse=True)
        root = np.arange(len(names))
        u, v = place[i], place[len(ask) + j]
        while len(u):
            p, r = root[u], root[v]
            apart = p != r
            u, v, p, r = u[apart], v[apart], p[apart], r[apart]
            np.minimum.at(root, np.maximum(p, r), np.minimum(p, r))
            while (root[root] != root).any():
                root = root[root]
        far = np.setdiff1d(np.flatnonzero(root != np.arange(len(names))), place[:len(ask)])
        return pa.table([
            pa.array(np.concatenate([ask, names[far]])), pa.array(np.concatenate([links, np.zeros(len(far), np.int64)])),
            pa.array(np.concatenate([names[root[place[:len(ask)]]], names[root[far]]]))], names=["node", "links", "root"])

    return searched.unionByName(asked).groupBy("shard", "block", "asked").applyInArrow(search, "node bigint, links bigint, root bigint")


def _audit(nodes: DataFrame, found: DataFrame, dim: int, least: float) -> float | None:
    """Mean over sampled nodes with links of the share of these that was found, by brute
    force over all nodes; null if no node of the largest sample has any."""
    recall = None
    for size in AUDIT_SIZES:
        sample = nodes.orderBy(F.xxhash64("node")).limit(size).select("node", "embedding").toArrow()
        if not sample.num_rows:
            break
        q, ask = matrix(sample["embedding"], dim), sample["node"].to_numpy()

        def run(batches: Iterator[pa.RecordBatch], q=q, ask=ask) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(ask), np.int64)
            for batch in batches:
                if batch.num_rows:
                    x, node, copies = matrix(batch.column("embedding"), dim), batch.column("node").to_numpy(), batch.column("copies").to_numpy()
                    for a in range(0, len(ask), AT_ONCE):
                        near = q[a:a + AT_ONCE] @ x.T >= least
                        near &= ask[a:a + AT_ONCE, None] != node[None]
                        total[a:a + AT_ONCE] += near @ copies
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(ask[some]), pa.array(total[some])], names=["node", "due"])

        due = nodes.mapInArrow(run, "node bigint, due bigint").groupBy("node").agg(F.sum("due").alias("due"))
        share = F.least(F.coalesce("links", F.lit(0)) / F.col("due"), F.lit(1.0))
        linked, recall = due.join(found, "node", "left").agg(F.count("*"), F.avg(share)).first()
        if linked >= AUDITED or sample.num_rows < size:
            break
    return recall


def near_duplicates(embeddings: DataFrame, least: float = LEAST_COSINE, overlap: int = OVERLAP) -> DataFrame:
    """(vec_id, n_links, component_id, kept, audited_recall) per row of ``embeddings``."""
    ship_package(embeddings.sparkSession)
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    fine = F.coalesce(
        (F.size("embedding") > 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("fine", fine)
    # stored, so that the numbers stay
    nodes = materialise(
        rows.where("fine").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    dim = nodes.agg(F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()[0]
    slim = nodes.select("node", "copies", "embedding")
    while True:
        found = materialise(_links(slim, dim, overlap, least), "links")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        recall = _audit(slim, links, dim, least)
        if recall is None or recall >= LEAST_RECALL:
            break
        if not overlap:
            raise ValueError(f"a recall of {recall} with all blocks compared")
        overlap = 2 * overlap if 2 * overlap <= MOST_OVERLAP else 0
    joined = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    rooted = nodes.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node")).join(links, "node", "left")
    tops = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(tops, "root").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.where("fine").join(classes, "embedding").select("vec_id", "n_links", "component_id").unionByName(
        rows.where("NOT fine").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.equal_null("vec_id", "component_id")).withColumn("audited_recall", F.lit(recall).cast("double"))
