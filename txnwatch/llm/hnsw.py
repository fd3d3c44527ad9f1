"""Embedding near-duplicates with a navigable small-world graph per shard.

Vectors are compared within a label.  Equal vectors are one class.  A label's
classes are hashed into shards of about ``shard_rows``; a task builds a hierarchical
small-world graph of its shard and writes it as a row.  Every vector is then a
query to every shard of its label, in blocks of about ``block_rows``, so a label of any
size is many independent tasks of bounded memory.

A search keeps ``beam`` best nodes.  Queries whose beam ends inside the link radius
are searched again with twice the beam, until the radius is exhausted.  Each task
also audits itself: for a sample of its queries it compares all vectors of the
shard, and it widens the beam for all queries while less than ``recall`` of their
links were found.  Links count only if the cosine in double precision reaches the
threshold.

A task returns per query the number of copies linked and one edge to each connected
group of linked nodes, never the pairs; the edges' components are the result.

Defined results: a null label or vector, an empty or zero vector, or one with null or
non-finite components links with nothing.  Vectors of different length never link.
Rows with equal vectors of a label link with each other.  Rows that repeat a vec_id
are rows of their own.  A null vec_id is never a component id while another member
has one.  Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.graph import components

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
DEGREE = 16
BUILD_BEAM = 48
BEAM = 48
RECALL = 0.99
AUDIT = 64
_QUERIES = 256
_SLACK = 1e-5


class Graph:
    """Hierarchical small-world graph over unit vectors, built and searched in batches."""

    def __init__(self, unit: np.ndarray, levels: list[np.ndarray], links: list[np.ndarray]):
        self.unit, self.levels, self.links = unit, levels, links

    @classmethod
    def build(cls, unit: np.ndarray, seed: int = 7) -> Graph:
        """``levels[k]`` are the nodes of level k (all at 0) and ``links[k]`` their
        neighbours, as node numbers; -1 is no neighbour."""
        n = len(unit)
        order = np.random.default_rng(seed).random(n)
        levels, keep = [], np.arange(n)
        while True:
            levels.append(keep)
            if len(keep) <= DEGREE * 2:
                break
            keep = keep[order[keep] < DEGREE ** -float(len(levels))]
            if not len(keep):
                break
        graph = cls(unit, levels, [np.full((n, 2 * DEGREE), -1, np.int32) for _ in levels])
        for k in range(len(levels) - 1, -1, -1):
            graph._fill(k)
        return graph

    def _fill(self, k: int) -> None:
        """Inserts the nodes of a level in batches; later batches search earlier ones."""
        nodes = self.levels[k]
        above = self.levels[k + 1] if k + 1 < len(self.levels) else nodes[:1]
        rest = nodes[~np.isin(nodes, above)]
        # nodes of a higher level are linked already; here they keep those links to begin with
        if k + 1 < len(self.levels):
            self.links[k][above] = self.links[k + 1][above]
        done = len(above)
        at = 0
        while at < len(rest):
            batch = rest[at:at + min(_QUERIES, max(16, done))]
            ids, sims = self.search(self.unit[batch], BUILD_BEAM, bottom=k)
            near = self.unit[batch] @ self.unit[batch].T  # members of a batch see each other
            np.fill_diagonal(near, -2)
            cand = np.concatenate([ids, np.broadcast_to(batch, near.shape)], 1)
            sim = np.concatenate([sims, near], 1)
            self._link(k, batch, cand, sim)
            at += len(batch)
            done += len(batch)

    def _link(self, k: int, nodes: np.ndarray, cand: np.ndarray, sim: np.ndarray) -> None:
        """Connects nodes with diverse near candidates, and those back with them."""
        width = min(4 * DEGREE, cand.shape[1])
        top = np.argpartition(-sim, width - 1, axis=1)[:, :width] if cand.shape[1] > width else \
            np.broadcast_to(np.arange(width), (len(nodes), width))
        sim, cand = np.take_along_axis(sim, top, 1), np.take_along_axis(cand, top, 1)
        by = np.argsort(-sim, axis=1, kind="stable")
        sim, cand = np.take_along_axis(sim, by, 1), np.take_along_axis(cand, by, 1)
        cand = np.where(sim > -1.5, cand, -1)
        chosen = self._diverse(cand, sim, DEGREE)
        links = self.links[k]
        links[nodes, :DEGREE] = chosen
        src, dst = np.repeat(nodes, DEGREE), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        near = np.einsum("pd,pd->p", self.unit[src], self.unit[dst])
        order = np.lexsort((-near, dst))
        src, dst = src[order], dst[order]
        first = np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]])) if len(dst) else np.zeros(0, int)
        place = np.arange(len(dst)) - np.repeat(first, np.diff(np.append(first, len(dst))))
        back = place < 2 * DEGREE  # a node gets its nearest new neighbours
        to = dst[first]
        new = np.full((len(to), 2 * DEGREE), -1, links.dtype)
        new[np.searchsorted(to, dst[back]), place[back]] = src[back]
        old = links[to]
        new[(new[:, :, None] == old[:, None, :]).any(2)] = -1
        both = np.concatenate([old, new], 1)
        sim = np.where(both >= 0, np.einsum("qcd,qd->qc", self.unit[np.maximum(both, 0)], self.unit[to]), -2)
        by = np.argsort(-sim, axis=1, kind="stable")
        both, sim = np.take_along_axis(both, by, 1), np.take_along_axis(sim, by, 1)
        links[to] = both[:, :2 * DEGREE]
        many = np.flatnonzero(both[:, 2 * DEGREE] >= 0) if both.shape[1] > 2 * DEGREE else np.zeros(0, int)
        for at in range(0, len(many), _QUERIES):
            part = many[at:at + _QUERIES]
            width = int((both[part] >= 0).sum(1).max())
            links[to[part]] = self._diverse(both[part, :width], sim[part, :width], 2 * DEGREE)

    def _diverse(self, cand: np.ndarray, sim: np.ndarray, degree: int) -> np.ndarray:
        """Of candidates sorted by similarity, those closer to the node than to a chosen
        one; free places go to the nearest of the others."""
        q, c = cand.shape
        vec = self.unit[np.maximum(cand, 0)]
        between = np.einsum("qcd,qed->qce", vec, vec)
        pick = np.zeros((q, c), bool)
        shadow = np.full((q, c), -2.0, np.float32)
        count = np.zeros(q, int)
        for j in range(c):
            take = (cand[:, j] >= 0) & (shadow[:, j] < sim[:, j]) & (count < degree)
            pick[:, j] = take
            count += take
            shadow = np.where(take[:, None], np.maximum(shadow, between[:, j]), shadow)
        score = np.where(cand >= 0, np.where(pick, 0, c) + np.arange(c), 4 * c)
        top = np.argsort(score, axis=1, kind="stable")[:, :degree]
        out = np.take_along_axis(cand, top, 1)
        return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1) if out.shape[1] < degree else out

    def search(self, queries: np.ndarray, beam: int, bottom: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Per query the ids and similarities of the best nodes found (-1: none)."""
        start = np.full((len(queries), 1), self.levels[-1][0])
        for k in range(len(self.levels) - 1, bottom, -1):
            ids, _ = self._walk(queries, start, k, 4)
            start = ids[:, :2]
        return self._walk(queries, start, bottom, beam)

    def _walk(self, queries: np.ndarray, start: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        q, n = len(queries), len(self.unit)
        links = self.links[k]
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True  # where missing neighbours point
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -2, np.float32)
        wide = start.shape[1]
        first = np.where(start >= 0, start, n)
        twice = np.zeros(start.shape, bool)
        for j in range(1, wide):
            twice[:, j] = (first[:, :j] == first[:, j:j + 1]).any(1)
        first = np.where(twice, n, first)
        width = min(wide, beam)
        ids[:, :width] = np.where(first < n, first, -1)[:, :width]
        sims[:, :width] = np.where(first < n, np.einsum("qwd,qd->qw", self.unit[np.minimum(first, n - 1)], queries), -2)[:, :width]
        seen[np.arange(q)[:, None], first] = True
        open_ = ids >= 0
        live = np.arange(q)
        while len(live):
            score = np.where(open_[live], sims[live], -3)
            best = np.argmax(score, 1)
            more = score[np.arange(len(live)), best] > -2.5
            live, best = live[more], best[more]
            if not len(live):
                break
            open_[live, best] = False
            nxt = links[ids[live, best]]
            nxt = np.where(nxt >= 0, nxt, n)
            fresh = ~seen[live[:, None], nxt]
            seen[live[:, None], nxt] = True
            s = np.einsum("qwd,qd->qw", self.unit[np.minimum(nxt, n - 1)], queries[live])
            s = np.where(fresh, s, -2).astype(np.float32)
            all_s = np.concatenate([sims[live], s], 1)
            all_i = np.concatenate([ids[live], np.where(fresh, nxt, -1)], 1)
            all_o = np.concatenate([open_[live], fresh], 1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[live], ids[live] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1)
            open_[live] = np.take_along_axis(all_o, top, 1)
        by = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, by, 1), np.take_along_axis(sims, by, 1)


def range_search(graph: Graph, queries: np.ndarray, radius: float, beam: int = BEAM, recall: float = RECALL
                 ) -> list[np.ndarray]:
    """Nodes with similarity >= radius per query: beams widen where they end inside the
    radius, and for all queries until the audit of a sample passes."""
    n, low = len(graph.unit), radius - _SLACK
    sample = np.linspace(0, len(queries) - 1, min(AUDIT, len(queries))).astype(int)
    truth = queries[sample] @ graph.unit.T >= low
    while True:
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        todo, width = np.arange(len(queries)), beam
        while len(todo):
            width = min(width, n)
            again = []
            block = max(8, _QUERIES * BEAM // max(width, BEAM))
            for a in range(0, len(todo), block):
                part = todo[a:a + block]
                ids, sims = graph.search(queries[part], width)
                inside = sims >= low
                full = inside[:, -1] & (width < n)
                again.append(part[full])
                for i in np.flatnonzero(~full).tolist():
                    out[part[i]] = ids[i][inside[i]]
            todo, width = np.concatenate(again), width * 2
        found = sum(int(truth[i][out[s]].sum()) for i, s in enumerate(sample))
        if found >= recall * truth.sum() or beam >= n:
            return out
        beam = min(2 * beam, n)


BROADCAST_LABELS = 100_000
_INDEX = "label long, shard int, cids binary, copies binary, vecs binary, dim int, levels binary, links binary"


def _build(key: tuple, t: pa.Table) -> pa.Table:
    t = t.sort_by("cid")
    cids = np.frombuffer(b"".join(t["cid"].to_pylist()), np.uint8).reshape(-1, 16)
    dim = int(key[2].as_py())
    vecs = np.frombuffer(b"".join(t["vec"].to_pylist()), np.float64).reshape(-1, dim)
    unit = (vecs / np.linalg.norm(vecs, axis=1, keepdims=True)).astype(np.float32)
    graph = Graph.build(unit)
    height = np.zeros(len(unit), np.uint8)
    for k, nodes in enumerate(graph.levels):
        height[nodes] = k
    return pa.table({
        "label": pa.array([key[0].as_py()], pa.int64()), "shard": pa.array([key[1].as_py()], pa.int32()),
        "cids": pa.array([cids.tobytes()], pa.binary()),
        "copies": pa.array([t["copies"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "vecs": pa.array([vecs.tobytes()], pa.binary()), "dim": pa.array([dim], pa.int32()),
        "levels": pa.array([height.tobytes()], pa.binary()),
        "links": pa.array([b"".join(x[nodes].tobytes() for x, nodes in zip(graph.links, graph.levels))], pa.binary())})


def _open(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    vecs = np.frombuffer(row["vecs"], np.float64).reshape(-1, row["dim"])
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    height = np.frombuffer(row["levels"], np.uint8)
    levels = [np.flatnonzero(height >= k) for k in range(int(height.max()) + 1)]
    raw, links, at = np.frombuffer(row["links"], np.int32).reshape(-1, 2 * DEGREE), [], 0
    for nodes in levels:
        full = np.full((len(vecs), 2 * DEGREE), -1, np.int32)
        full[nodes] = raw[at:at + len(nodes)]
        at += len(nodes)
        links.append(full)
    cids = np.frombuffer(row["cids"], np.uint8).reshape(-1, 16)
    return Graph(unit.astype(np.float32), levels, links), unit, cids, np.frombuffer(row["copies"], np.int64)


def _pack(key: tuple, t: pa.Table) -> pa.Table:
    """A block of queries as one row."""
    return pa.table({"label": pa.array([key[0].as_py()], pa.int64()), "dim": pa.array([key[2].as_py()], pa.int32()),
                     "block": pa.array([key[1].as_py()], pa.int32()),
                     "q_cids": pa.array([b"".join(t["cid"].to_pylist())], pa.binary()),
                     "q_vecs": pa.array([b"".join(t["vec"].to_pylist())], pa.binary())})


def _query(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                graph, unit, cids, copies = _open(row)
                q = np.frombuffer(row["q_vecs"], np.float64).reshape(-1, row["dim"])
                q_unit = q / np.linalg.norm(q, axis=1, keepdims=True)
                q_cids = [bytes(c) for c in np.frombuffer(row["q_cids"], np.uint8).reshape(-1, 16)]
                node_of = {bytes(c): j for j, c in enumerate(cids)}
                near = range_search(graph, q_unit.astype(np.float32), threshold)
                group = np.arange(len(unit))  # linked nodes of this shard, by smallest node

                def root(i: int) -> int:
                    while group[i] != i:
                        group[i] = group[group[i]]
                        i = group[i]
                    return i
                u, v, counts = [], [], []
                for i, nodes in enumerate(near):
                    me = node_of.get(q_cids[i], -1)
                    nodes = nodes[(unit[nodes] @ q_unit[i] >= threshold) & (nodes != me)]
                    counts.append(int(copies[nodes].sum()))
                    joined = {root(int(j)) for j in nodes}
                    if me >= 0 and joined:
                        joined.add(root(me))
                    low = min(joined, default=-1)
                    for r in joined:  # one edge to each group that this query brings together
                        group[r] = low
                        if r != me:
                            u.append(q_cids[i])
                            v.append(bytes(cids[r]))
                linked = [i for i, c in enumerate(counts) if c]
                yield pa.record_batch([
                    pa.array([row["label"]] * (len(linked) + len(u)), pa.int64()),
                    pa.array([q_cids[i] for i in linked] + u, pa.binary()),
                    pa.array([None] * len(linked) + v, pa.binary()),
                    pa.array([counts[i] for i in linked] + [0] * len(u), pa.int64())], names=["label", "u", "v", "n"])
    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid (128-bit fingerprint of the vector) and the vector as doubles; null if it
    cannot link."""
    for batch in batches:
        cid, vec, dim = [], [], []
        labels = batch.column(2).to_pylist()
        for e, label in zip(batch.column(1), labels):
            x = None
            if label is not None and e.is_valid and len(e.values) and not e.values.null_count:
                x = e.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(x).max()
                if not np.isfinite(top) or not top:
                    x = None
                elif not 1e-100 < top < 1e100:  # by a power of two, so that squares stay in range
                    x = np.ldexp(x, -int(np.frexp(top)[1]))
            blob = None if x is None else (x + 0.0).tobytes()
            cid.append(None if x is None else hashlib.blake2b(blob, digest_size=16).digest())
            vec.append(blob)
            dim.append(None if x is None else len(x))
        yield pa.record_batch([batch.column(0), pa.array(labels, pa.int64()), pa.array(cid, pa.binary()),
                               pa.array(vec, pa.binary()), pa.array(dim, pa.int32())],
                              names=["vec_id", "label", "cid", "vec", "dim"])


def _numbered_labels(rows: DataFrame) -> DataFrame:
    """Labels that are no whole numbers are numbered, each by its own value."""
    if isinstance(rows.schema["label"].dataType, T.IntegralType):
        return rows
    known = rows.select(F.col("label").alias("_label")).where("_label IS NOT NULL").distinct()
    known = known.withColumn("_n", F.monotonically_increasing_id()).checkpoint()
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    return rows.join(known, F.col("label") == F.col("_label"), "left").withColumn("label", F.col("_n"))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93, shard_rows: int = SHARD_ROWS,
                           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``
    (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"), "label")
    rows = _numbered_labels(rows).select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    rows = rows.mapInArrow(_classes, "vec_id long, label long, cid binary, vec binary, dim int").checkpoint()
    key = ["label", "dim", "cid"]
    classes = (rows.filter("cid IS NOT NULL").groupBy(*key)
               .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep"), F.first("vec").alias("vec")))
    shards = (classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("k"))
              .select("label", "dim", "k", F.ceil(F.col("k") / shard_rows).cast("int").alias("shards")))
    placed = classes.join(shards, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int"))
    index = placed.select("label", "shard", "dim", "cid", "copies", "vec").groupBy("label", "shard", "dim").applyInArrow(
        _build, _INDEX).checkpoint()
    blocks = (placed.withColumn("block", F.pmod(F.xxhash64(F.lit(1), F.col("cid")), F.ceil(F.col("k") / block_rows))
                                .cast("int"))
              .select("label", "block", "dim", "cid", "vec").groupBy("label", "block", "dim")
              .applyInArrow(_pack, "label long, dim int, block int, q_cids binary, q_vecs binary").checkpoint())
    # the work list first, without payloads; then its rows meet their index and their block
    todo = index.select("label", "dim", "shard").join(blocks.select("label", "dim", "block"), ["label", "dim"])
    n_tasks = max(1, todo.count())
    todo = todo.join(index, ["label", "dim", "shard"]).join(blocks, ["label", "dim", "block"])
    found = (todo.repartition(min(n_tasks, 20_000), "label", "dim", "shard", "block")
             .mapInArrow(_query(threshold), "label long, u binary, v binary, n long").checkpoint())
    # a fingerprint may occur under several labels: nodes carry their label
    node = "concat(cast(label as string), ':', hex({0}))"
    links = found.filter("v IS NOT NULL").selectExpr(f"{node.format('u')} as u", f"{node.format('v')} as v")
    counts = found.filter("v IS NULL").selectExpr(f"{node.format('u')} as cnode", "n").groupBy("cnode").agg(
        F.sum("n").alias("others"))
    named = classes.selectExpr(f"{node.format('cid')} as node", "copies", "rep")
    comp = components(links)
    label = (comp.join(named.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("low")))
    info = (named.join(comp, "node", "left").join(label, "root", "left")
            .join(counts, F.col("node") == F.col("cnode"), "left")
            .select("node", F.coalesce("low", "rep").alias("component_id"),
                    (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    out = rows.selectExpr("vec_id", f"{node.format('cid')} as node").join(info, "node", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
