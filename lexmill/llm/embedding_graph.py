"""Near-duplicate vectors by a flat, robust-pruned neighbour graph.

1. Equal vectors of a label are one class. Centroids of a bounded sample cut each label into shards that overlap: a vector
   also joins those whose cell border is near enough for a linked one to lie behind it. How near that is, links of the data itself say: some
   vectors are compared with all of their label, and the borders take in what nearly all of their links need; where they have too few, what any link could need.
2. Each shard, in blocks of bounded size, builds a graph: nearest and random candidates are pruned so that no kept neighbour
   makes another one needless. The adjacency lists that a vector has in its shards are united.
3. Each vector is searched for in its home shard: greedily from the medoids, then on from everything in range until nothing
   new is in range. Some queries of each task are audited against an exact scan; where recall falls short, the beam widens.
4. Whatever is found is verified by cosine in double precision and counts for both ends. Only counts and one link for each vector leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.base import batches
from lexmill.operators.components import connected_components
from lexmill.session import spread, stored, unstore

#: Vectors that centroids are fitted on, of a shard as it should be, of a block at most; neighbours kept, of them random; beam.
SAMPLE, SHARD, BLOCK, NEAR, FAR, BEAM = 20_000, 1_000, 4_096, 20, 6, 16
#: Queries of a task that are audited, and the recall they have to reach.
AUDIT, RECALL = 32, 0.99
#: Vectors compared with all of their label, links they must have to set the borders by, share of these links that borders take in, and steps of a border's width.
PROBES, ENOUGH, TAKEN, STEPS = 256, 500, 0.9995, 64


def matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means."""
    r = np.random.default_rng(seed)
    c = x[r.permutation(len(x))[:k]]
    for _ in range(rounds if k > 1 else 1):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), c)
    return c


def widest(threshold: float) -> float:
    """How far a linked vector's home cell can lie from a vector at most, in ``cells``' measure; a hair more, for rounding."""
    return math.sqrt(max(0.0, 1 - threshold**2)) + 1e-6 if threshold > 0 else 1.0 + 1e-6


def needs(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    """For unit vectors in pairs, the border that brings one of them into the other's home cell: 0 where they have the same."""
    hx, hy = (x @ c.T).argmax(1), (y @ c.T).argmax(1)
    apart = np.maximum(np.linalg.norm(c[hx] - c[hy], axis=1), 1e-6)
    step = c[hx] - c[hy]
    return np.where(hx == hy, 0.0, np.minimum(np.einsum("ij,ij->i", x, step), -np.einsum("ij,ij->i", y, step)) / apart)


def cells(x: np.ndarray, c: np.ndarray, threshold: float, share: float = 1.0) -> list[list[int]]:
    """The clusters of each unit vector, its home first, then all that can be home to a vector linked with it.

    A cell's border is a plane through the origin; what is linked over it stands at no larger an angle to it than the threshold's, whatever the data.
    ``share``: how much of that width the border takes in.
    """
    sims = x @ c.T
    home = sims.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * c @ c.T, 1e-12))
    margin = share * widest(threshold)
    out = []
    for i, h in enumerate(home.tolist()):
        near = np.flatnonzero(sims[i, h] - sims[i] <= margin * apart[h])
        out.append([h, *(int(k) for k in near if k != h)])
    return out


def pruned(x: np.ndarray, seed: int, alpha: float = 1.2) -> np.ndarray:
    """Neighbours of each row, padded with -1: candidates by nearness, each kept unless one kept before is nearer to it by the factor alpha than the row is; then random ones."""
    n = len(x)
    if n == 1:
        return np.full((1, 1), -1, np.int32)
    k = min(n - 1, 3 * NEAR)
    out = np.full((n, min(NEAR, k) + min(FAR, n - 1)), -1, np.int32)
    r = np.random.default_rng(seed)
    x32 = x.astype(np.float32)
    for a in range(0, n, 512):
        rows = np.arange(a, min(n, a + 512))
        sims = x32[rows] @ x32.T
        sims[np.arange(len(rows)), rows] = -2
        cand = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        s = np.take_along_axis(sims, cand, 1)
        by = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, by, 1), np.take_along_axis(s, by, 1)
        y = x32[cand]
        between = np.maximum(0, 2 - 2 * y @ y.transpose(0, 2, 1))
        own = np.maximum(0, 2 - 2 * s)
        alive, kept = np.ones_like(s, bool), np.zeros_like(s, bool)
        for j in range(k):
            take = alive[:, j] & (kept.sum(1) < NEAR)
            kept[:, j] = take
            # squared distances, so the factor is squared too
            alive &= ~(take[:, None] & (alpha**2 * between[:, j] <= own))
        for i, row in enumerate(rows):
            near = cand[i, kept[i]]
            if len(near) < min(NEAR // 2, k):
                # what pruning left out, nearest first, so that a place among equals keeps its ways
                rest = cand[i, ~kept[i]][: min(NEAR // 2, k) - len(near)]
                near = np.concatenate((near, rest))
            out[row, : len(near)] = near
            out[row, -min(FAR, n - 1) :] = r.integers(0, n, min(FAR, n - 1))
    return out


class Graph:
    """Vectors of a block with their neighbours; links count both ways."""

    def __init__(self, x: np.ndarray, lists: list[np.ndarray]):
        n = len(x)
        self.x = x
        a = np.repeat(np.arange(n), [len(v) for v in lists])
        b = np.concatenate(lists).astype(np.int64) if n else np.zeros(0, np.int64)
        pair = np.unique(np.concatenate((a * n + b, b * n + a)))
        a, b = pair // n, pair % n
        a, b = a[a != b], b[a != b]
        self.start = np.searchsorted(a, np.arange(n + 1))
        self.to = b
        self.medoids = self._medoids()

    def around(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``nodes``, neighbour) of all neighbours."""
        size = self.start[nodes + 1] - self.start[nodes]
        pos = np.repeat(np.arange(len(nodes)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.start[nodes], size)
        return pos, self.to[at]

    def _medoids(self) -> np.ndarray:
        """The vector nearest to the mean of each part of the graph that hangs together."""
        n = len(self.x)
        part = np.full(n, -1)
        out = []
        for s in range(n):
            if part[s] >= 0:
                continue
            part[s] = s
            front = np.array([s])
            while len(front):
                front = np.unique(self.around(front)[1])
                front = front[part[front] < 0]
                part[front] = s
            inside = np.flatnonzero(part == s)
            out.append(inside[(self.x[inside] @ self.x[inside].mean(0)).argmax()])
        return np.array(out)

    def search(self, q: np.ndarray, own: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all pairs found in range. own: a query's own node or -1; it is a way in beside the medoids."""
        n, m = len(self.x), len(q)
        seen = np.zeros((m, n), bool)
        inside = np.zeros((m, n), bool)
        ids = np.full((m, beam), -1)
        sims = np.full((m, beam), -2.0)
        done = np.ones((m, beam), bool)

        def visit(qi: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Of pairs not seen before: (query, node, cosine); marks them."""
            key = np.unique(qi * n + node)
            qi, node = key // n, key % n
            new = ~seen[qi, node]
            qi, node = qi[new], node[new]
            seen[qi, node] = True
            s = np.concatenate([np.einsum("ij,ij->i", q[qi[i : i + 65536]], self.x[node[i : i + 65536]]) for i in range(0, len(qi), 65536)]) if len(qi) else np.zeros(0)
            inside[qi, node] = s >= threshold
            return qi, node, s

        def offer(qi: np.ndarray, node: np.ndarray, s: np.ndarray) -> None:
            """Puts visited nodes into the beams."""
            by = np.lexsort((-s, qi))
            qi, node, s = qi[by], node[by], s[by]
            first = np.searchsorted(qi, np.arange(m))
            rank = np.arange(len(qi)) - first[qi]
            ok = rank < beam
            qi, node, s, rank = qi[ok], node[ok], s[ok], rank[ok]
            rows = np.unique(qi)
            if not len(rows):
                return
            at = np.searchsorted(rows, qi)
            new_id, new_s = np.full((len(rows), beam), -1), np.full((len(rows), beam), -2.0)
            new_id[at, rank], new_s[at, rank] = node, s
            all_id, all_s, all_done = np.hstack((ids[rows], new_id)), np.hstack((sims[rows], new_s)), np.hstack((done[rows], new_id < 0))
            top = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
            ids[rows], sims[rows], done[rows] = (np.take_along_axis(v, top, 1) for v in (all_id, all_s, all_done))

        starts = np.concatenate((np.tile(self.medoids, m), own[own >= 0]))
        offer(*visit(np.concatenate((np.repeat(np.arange(m), len(self.medoids)), np.flatnonzero(own >= 0))), starts))
        while len(rows := np.flatnonzero(~done.all(1))):
            best = np.where(done[rows], -3.0, sims[rows]).argmax(1)
            done[rows, best] = True
            pos, node = self.around(ids[rows, best])
            offer(*visit(rows[pos], node))
        spread_out = np.zeros((m, n), bool)
        while True:
            qi, node = np.nonzero(inside & ~spread_out)
            if not len(qi):
                break
            spread_out[qi, node] = True
            for a in range(0, len(qi), 16384):
                pos, to = self.around(node[a : a + 16384])
                visit(qi[a : a + 16384][pos], to)
        return np.nonzero(inside)


def near_duplicates(df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept, audit_links, audit_found) of every row: rows of one label link at a cosine of ``threshold`` or more.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null id or label, link with nothing: n_links 0, component_id
    their own id. Vectors of different lengths don't link. Rows that repeat an id are one vector and all come out; equal vectors
    link. component_id is the smallest id reachable by links; kept says that it is the row's own. audit_links and audit_found: for PROBES vectors the links that an exact
    scan of their whole label has and those found, else null; ties between equally near vectors decide no link. Other columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    batches(spark, 2000)
    v = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in v.schema}
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = v.where("id is not null and label is not null and v is not null").where(fine)
    classes = stored(good.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("w")), "vectors")
    total, labels = classes.agg(F.count("*"), F.approx_count_distinct("label")).first()
    if not total:
        return v.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"), *(F.lit(None).cast("long").alias(c) for c in ("audit_links", "audit_found")))
    sample = classes.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("v").toPandas()["v"]
    by_size: dict[int, list] = {}
    for x in sample:
        by_size.setdefault(len(x), []).append(x)
    k = max(1, round(total / (SHARD * max(1, labels))))
    centers = {}
    for d, x in by_size.items():
        x = np.array(x, np.float64)
        x = unit(x / np.abs(x).max(1, keepdims=True))
        centers[d] = centroids(x, min(k, max(1, len(x) // 10)))

    asked_all, share = _probes(classes, centers, threshold)

    def assign(parts):
        for b in parts:
            lists = b.column("v").to_pylist()
            out: list = [[0]] * len(lists)
            for d in {len(x) for x in lists}:
                at = [i for i, x in enumerate(lists) if len(x) == d]
                if d in centers:
                    x = np.array([lists[i] for i in at], np.float64)
                    x = unit(x / np.abs(x).max(1, keepdims=True))
                    for i, c in zip(at, cells(x, centers[d], threshold, share), strict=True):
                        out[i] = c
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))], [*b.schema.names, "cells"])

    placed = spread(classes).mapInArrow(assign, f"label {kinds['label']}, v {kinds['v']}, rep {kinds['id']}, w bigint, cells array<int>")
    member = placed.select("label", F.size("v").alias("d"), "rep", "v", "w", F.get("cells", F.lit(0)).alias("hc"), "cells", F.posexplode("cells").alias("pos", "cell")).withColumn("home", F.col("pos") == 0).drop("pos")
    member = member_at = stored(member, "members")
    shard = ["label", "d", "cell"]
    sizes = member.groupBy(*shard).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.count_if("home") / BLOCK)).cast("int").alias("chunks"))
    member = member.join(sizes, shard).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(1)), "chunks").cast("int"))

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("rep").to_pylist()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        ids = [ids[i] for i in order]
        x = matrix(t.column("v"))[order]
        x = unit(x / np.abs(x).max(1, keepdims=True))
        out = pruned(x, len(ids))
        lists = [[ids[j] for j in row[row >= 0].tolist()] for row in out]
        return pa.table({"rep": pa.array(ids, t.schema.field("rep").type), "to": pa.array(lists, pa.list_(t.schema.field("rep").type))})

    lists = member.groupBy(*shard, "block").applyInArrow(build, f"rep {kinds['id']}, to array<{kinds['id']}>")
    graph = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to"))
    whole = member.join(graph, "rep")
    data = whole.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*shard, F.col("block").alias("b"), "c", "rep", "v", "w", "hc", "cells", "to", F.lit(True).alias("indexed"), (F.col("home") & (F.col("chunk") == F.col("c"))).alias("asked"))
    asked = whole.where("home and blocks > 1").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("b <> block").select(*shard, "b", F.col("chunk").alias("c"), "rep", "v", "w", "hc", "cells", F.col("to"), F.lit(False).alias("indexed"), F.lit(True).alias("asked"))

    def search(t: pa.Table) -> pa.Table:
        return _search(t, threshold)

    found = data.unionByName(asked).groupBy(*shard, "b", "c").applyInArrow(search, f"rep {kinds['id']}, root {kinds['id']}, links bigint")
    found = stored(found, "found")
    unstore(member_at)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    whole_parts = connected_components(found, "rep", "root").withColumnRenamed("node", "rep")
    named = classes.join(counts, "rep", "left").join(whole_parts, "rep", "left").join(F.broadcast(asked_all), "rep", "left").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"), F.coalesce("component", "rep").alias("component"), "audit_links")
    out = v.join(named, ["label", "v"], "left").withColumn("component", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")))
    links = F.when(F.col("id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select(F.col("id").alias(id_col), links.alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("id"), F.lit(False)).alias("kept"), "audit_links", F.when(F.col("audit_links").isNotNull(), links).alias("audit_found"))


def _probes(classes: DataFrame, centers: dict[int, np.ndarray], threshold: float) -> tuple[DataFrame, float]:
    """Links of PROBES classes by an exact scan of all: (rep, audit_links) rows, and the share of the widest border that takes in TAKEN of them.

    The probes go to every task; what comes back is a number for each probe and step.
    """
    spark = classes.sparkSession
    rows = classes.orderBy(F.xxhash64("rep", F.lit(11)), "rep").limit(PROBES).toPandas()
    reps, labels, weight = rows["rep"].tolist(), np.array(rows["label"].tolist(), dtype=object), rows["w"].to_numpy()
    by_size = {}
    for i, v in enumerate(rows["v"]):
        by_size.setdefault(len(v), []).append(i)
    probes = {}
    for d, at in by_size.items():
        x = np.array([rows["v"][i] for i in at], np.float64)
        probes[d] = np.array(at), unit(x / np.abs(x).max(1, keepdims=True))
    wide, steps = widest(threshold), STEPS

    def scan(parts):
        links, bins = np.zeros(len(reps), np.int64), np.zeros(steps + 1, np.int64)
        for b in parts:
            lists, own, w, ids = b.column("v").to_pylist(), b.column("label").to_pylist(), b.column("w").to_numpy(), b.column("rep").to_pylist()
            for d, (at, q) in probes.items():
                here = [i for i, x in enumerate(lists) if len(x) == d]
                if not here:
                    continue
                x = np.array([lists[i] for i in here], np.float64)
                x = unit(x / np.abs(x).max(1, keepdims=True))
                i, j = np.nonzero(x @ q.T >= threshold)
                ok = np.array([own[here[a]] == labels[at[c]] and ids[here[a]] != reps[at[c]] for a, c in zip(i.tolist(), j.tolist(), strict=True)], bool)
                i, j = i[ok], j[ok]
                np.add.at(links, at[j], w[np.array(here)[i]] if len(i) else 0)
                if d in centers and len(i):
                    step = np.ceil(np.clip(needs(x[i], q[j], centers[d]) / wide, 0, 1) * steps).astype(np.int64)
                    bins += np.bincount(step, minlength=steps + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(links) + len(bins))), pa.array(np.concatenate((links, bins)))], ["i", "n"])

    got = np.zeros(len(reps) + steps + 1, np.int64)
    for r in spread(classes).mapInArrow(scan, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect():
        got[r["i"]] = r["n"]
    links, bins = got[: len(reps)], got[len(reps) :]
    many = max((len(c) for c in centers.values()), default=1) > 1
    share = 1.0
    if many and bins.sum() >= ENOUGH:
        share = min(1.0, (int(np.searchsorted(bins.cumsum(), TAKEN * bins.sum())) + 1) / steps)
    kind = classes.schema["rep"].dataType.simpleString()
    return spark.createDataFrame([(r, int(n) + int(w) - 1) for r, n, w in zip(reps, links, weight, strict=True)], f"rep {kind}, audit_links bigint"), share


def _search(t: pa.Table, threshold: float) -> pa.Table:
    rep = np.array(t.column("rep").to_pylist(), dtype=object)
    raw = matrix(t.column("v"))
    raw = raw / np.abs(raw).max(1, keepdims=True)
    x = unit(raw)
    w = np.array(t.column("w").to_pylist(), np.int64)
    indexed, asked = (np.array(t.column(c).to_pylist(), bool) for c in ("indexed", "asked"))
    at = np.flatnonzero(indexed)
    at = at[np.argsort(rep[at], kind="stable")]
    place = {r: i for i, r in enumerate(rep[at].tolist())}
    lists = [np.array([place[r] for r in row if r in place], np.int64) for row in (t.column("to")[i].as_py() for i in at.tolist())]
    q = np.flatnonzero(asked)
    id_type = t.schema.field("rep").type
    root = np.arange(len(rep))
    links = np.zeros(len(rep), np.int64)
    cell, homes = t.column("cell")[0].as_py(), t.column("hc").to_numpy()
    if len(at) and len(q):
        shards = t.column("cells").to_pylist()
        g = Graph(x[at], lists)
        own = np.array([place.get(r, -1) if indexed[i] else -1 for i, r in zip(q.tolist(), rep[q].tolist(), strict=True)])
        # a hair below the threshold; the exact check follows
        slack = threshold - 1e-9
        step = max(16, min(512, (1 << 22) // len(at)))
        probe = np.arange(0, len(q), max(1, -(-len(q) // AUDIT)))
        exact = x[q[probe]] @ x[at].T >= slack
        beam = BEAM
        while True:
            a, b = g.search(x[q[probe]], own[probe], slack, beam)
            got = np.zeros_like(exact)
            got[a, b] = True
            if beam >= len(at) or (got & exact).sum() >= RECALL * exact.sum():
                break
            beam *= 2
        for s in range(0, len(q), step):
            part = q[s : s + step]
            a, b = g.search(x[part], own[s : s + step], slack, beam)
            a, b = part[a], at[b]
            ok = (a != b) & (rep[a] != rep[b])
            a, b = a[ok], b[ok]
            # the exact check, by sums of products and norms of the vectors as they came
            na, nb = (np.sqrt(np.einsum("ij,ij->i", raw[i], raw[i])) for i in (a, b))
            ok = np.einsum("ij,ij->i", raw[a], raw[b]) / (na * nb) >= threshold
            a, b = a[ok], b[ok]
            links += np.bincount(a, w[b], len(rep)).astype(np.int64)
            # what is at home elsewhere looks for its links there, and does not find those that are not in that shard
            away = np.flatnonzero(homes[b] != cell)
            for i, j in zip(a[away].tolist(), b[away].tolist(), strict=True):
                if homes[j] not in shards[i]:
                    links[j] += w[i]
            while len(a):
                low = np.minimum(root[a], root[b])
                before = root.copy()
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
                root = root[root]
                if (root == before).all():
                    break
    # a place in the table has one identifier; the smallest place of a part is any member of it
    roots = [rep[i] for i in root.tolist()]
    return pa.table({"rep": pa.array(rep.tolist(), id_type), "root": pa.array(roots, id_type), "links": links})
