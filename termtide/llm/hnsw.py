"""Near duplicates among embeddings, by navigable small-world graphs per shard."""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.components import components, roots
from termtide.llm.tables import hinted, written

#: Vectors in a shard at most, on average, which bounds a task's memory.
SHARD = 32768
#: Below that, shards grow with the root of the number of vectors: as many as they are, times this.
ROOT = 1024
#: Links of a vector that are made when it comes in, and held at most, on the lowest layer.
LINKS, MOST = 12, 32
#: Beam widths, one after the other; then the whole shard is looked at.
BEAMS = (24, 96)
#: Queries in each pair of shard and block whose results are held against a full look.
AUDITED = 48
RECALL = 0.99


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def chosen(likeness: np.ndarray, among: np.ndarray, most: int) -> list[int]:
    """Of candidates, nearest first, half by direction, the rest by nearness.

    The first half are nearer to the vector than to any picked before, so that a vector in a
    cluster also keeps links that lead out of it; the others hold the cluster together.
    """
    picked: list[int] = []
    for i in range(len(likeness)):
        if 2 * len(picked) >= most:
            break
        if not picked or (among[i, picked] < likeness[i]).all():
            picked.append(i)
    rest = [i for i in range(len(likeness)) if i not in picked]
    return picked + rest[: most - len(picked)]


class Graph:
    """Layers of links over the vectors of a shard; all vectors are on the lowest."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        n = len(vectors)
        self.vectors = vectors.astype(np.float32)
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(draw) / np.log(LINKS)).astype(int), 4) if n else np.zeros(0, int)
        self.entry = int(level.argmax()) if n else 0
        self.layers = [self._layer(np.flatnonzero(level >= i), n) for i in range(level.max(initial=-1) + 1)]

    def _layer(self, nodes: np.ndarray, n: int) -> np.ndarray:
        """Vectors come in one by one; the nearest ones before each are found by a product."""
        links: dict[int, list[int]] = {int(x): [] for x in nodes}
        vectors = self.vectors
        for place in range(1, len(nodes)):
            node, earlier = int(nodes[place]), nodes[:place]
            likeness = vectors[earlier] @ vectors[node]
            few = min(len(earlier), 4 * LINKS)
            top = np.argpartition(-likeness, few - 1)[:few]
            top = top[np.argsort(-likeness[top], kind="stable")]
            near = earlier[top]
            among = vectors[near] @ vectors[near].T
            for i in chosen(likeness[top], among, LINKS):
                other = int(near[i])
                links[node].append(other)
                links[other].append(node)
                if len(links[other]) > MOST:
                    links[other] = self._pruned(other, links[other])
        table = np.full((n, MOST), -1, np.int32)
        for node, own in links.items():
            table[node, : len(own)] = own
        return table

    def _pruned(self, node: int, own: list[int]) -> list[int]:
        """Three quarters of the links, chosen as for a new vector."""
        near = np.array(own)
        likeness = self.vectors[near] @ self.vectors[node]
        order = np.argsort(-likeness, kind="stable")
        near, likeness = near[order], likeness[order]
        return near[chosen(likeness, self.vectors[near] @ self.vectors[near].T, 3 * MOST // 4)].tolist()

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query the beam's vectors (-1: none) and their likeness, from all layers down."""
        queries = queries.astype(np.float32)
        at = np.full(len(queries), self.entry)
        best = queries @ self.vectors[self.entry]
        for table in self.layers[:0:-1]:
            moving = np.arange(len(queries))
            while len(moving):
                near = table[at[moving]]
                like = np.einsum("qmd,qd->qm", self.vectors[near], queries[moving])
                like[near < 0] = -2
                top = like.argmax(axis=1)
                value = like[np.arange(len(moving)), top]
                better = value > best[moving]
                at[moving[better]] = near[np.arange(len(moving)), top][better]
                best[moving[better]] = value[better]
                moving = moving[better]
        n, table = len(queries), self.layers[0]
        who = np.full((n, beam), -1, np.int32)
        like = np.full((n, beam), -2, np.float32)
        open_ = np.zeros((n, beam), bool)
        who[:, 0], like[:, 0], open_[:, 0] = at, best, True
        seen = np.zeros((n, len(self.vectors) + 1), bool)
        seen[np.arange(n), at] = True
        seen[:, -1] = True
        going = np.arange(n)
        while len(going):
            every = np.arange(len(going))
            pick = np.where(open_[going], like[going], -3).argmax(axis=1)
            open_[going, pick] = False
            near = table[who[going, pick]]
            fresh = ~seen[going[:, None], near]
            seen[going[:, None], near] = True
            value = np.full(near.shape, -2, np.float32)
            q, m = np.nonzero(fresh & (near >= 0))
            value[q, m] = np.einsum("nd,nd->n", self.vectors[near[q, m]], queries[going[q]])
            all_like = np.concatenate([like[going], value], axis=1)
            all_who = np.concatenate([who[going], near], axis=1)
            all_open = np.concatenate([open_[going], value > -2], axis=1)
            top = np.argpartition(-all_like, beam - 1, axis=1)[:, :beam]
            like[going] = all_like[every[:, None], top]
            who[going] = all_who[every[:, None], top]
            open_[going] = all_open[every[:, None], top]
            going = going[open_[going].any(axis=1)]
        who[like <= -2] = -1
        return who, like


class Forest:
    """Components of links that come in by and by; a node is named by the least of its component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Only links between different components so far are looked at one by one."""
        a, b, n = self.label[a], self.label[b], len(self.label)
        apart = a != b
        pairs = np.unique(a[apart] * n + b[apart])
        if len(pairs):
            found = roots(zip((pairs // n).tolist(), (pairs % n).tolist()))
            to = np.arange(n)
            to[list(found)] = list(found.values())
            self.label = to[self.label]


def links_of(graph: Graph, exact: np.ndarray, queries: np.ndarray, least: float):
    """(query, vector) of all pairs with that cosine or more, in double precision, part by part.

    A query whose whole beam is that near is asked again with a wider one, and at last looks at the
    whole shard. If audited ones of the other queries miss links, those are asked again as well.
    """
    slack = least - 1e-4
    left = np.arange(len(queries))
    picked = lambda rows: rows[np.unique(np.linspace(0, len(rows) - 1, AUDITED).astype(int))]
    for beam in BEAMS:
        if not len(left) or 2 * beam >= len(exact):
            break
        kept, full = [], []
        for a in range(0, len(left), 1024):
            part = left[a : a + 1024]
            who, like = graph.search(queries[part], beam)
            near = like >= slack
            full.append(part[near.all(axis=1)])
            near &= ~near.all(axis=1)[:, None]
            q, m = np.nonzero(near)
            kept.append((part[q], who[q, m]))
        q, x = (np.concatenate(c) for c in zip(*kept))
        full = np.concatenate(full)
        sure = np.einsum("nd,nd->n", queries[q], exact[x]) >= least
        q, x = q[sure], x[sure]
        settled = np.setdiff1d(left, full)
        if len(settled):
            audit = picked(settled)
            due = (queries[audit] @ exact.T >= least).sum()
            if np.isin(q, audit).sum() < RECALL * due:
                continue
        yield q, x
        left = full
    for a in range(0, len(left), 256):
        part = left[a : a + 256]
        q, x = np.nonzero(queries[part] @ exact.T >= least)
        yield part[q], x


def recall_of(tally: np.ndarray, exact: np.ndarray, queries: np.ndarray, least: float) -> float:
    """Of links found per query, on some queries held against a full look."""
    audit = np.unique(np.linspace(0, len(queries) - 1, AUDITED).astype(int))
    truth = (queries[audit] @ exact.T >= least).sum()
    return float(tally[audit].sum() / truth) if truth else 1.0


def embedding_links(
    vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
    shard: int = SHARD,
) -> tuple[DataFrame, DataFrame]:
    """Per row id, n_links and component; and per shard and block the audited recall.

    Links are cosines of ``least`` or more in double precision. Vectors that are null, empty, zero
    or hold a null or a non-finite component link with nothing, nor do vectors of different
    lengths or ones with a null id. Equal vectors are one class in the graphs: its members, counted
    by id, are linked with each other and with what the class is linked with. A component is named
    by its smallest id. An empty table gives no rows. Other columns are not read.

    Vectors are dealt to shards by a hash of the id; one task builds a shard's graph, which is
    written. Every shard is then asked for its own vectors and for those of every block (the vectors
    of a shard) before it; a link found between two shards counts on both sides. Each pair of shard
    and block is a piece of work of its own, so no task holds more than two shards at a time. It
    returns counts and a spanning forest of its links, and never holds more links than those of
    256 vectors to a shard, or the beams'. Shards hold ``shard`` vectors at most, and while there
    are few of them grow with the root of all, so that searches don't grow with its square.
    """
    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good &= F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull()
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(good, v).alias("v"),
    ).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.hash("v"))
    rows = written(rows, "embeddings")
    usable = rows.where("v is not null")
    classes = written(
        usable.groupBy("k1", "k2").agg(
            F.min("id").alias("rep"), F.count_distinct("id").alias("copies"), F.first("v").alias("v")
        ),
        "embedding-classes",
    )
    count = classes.count()
    shards = max(1, -(-count // shard), math.ceil(math.sqrt(count / ROOT)))
    kind = np.float32 if dict(classes.dtypes)["v"] == "array<float>" else np.float64

    def built(key, table):
        matrix = np.asarray(table.column("v").combine_chunks().flatten(), kind).reshape(len(table), -1)
        order = np.argsort(table.column("rep").to_numpy(), kind="stable")
        matrix = matrix[order]
        graph = Graph(unit(matrix))
        ids = table.column("rep").to_numpy()[order], table.column("copies").to_numpy()[order]
        return pa.table({
            "size": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
            "vectors": pa.array([pickle.dumps((*ids, matrix))], pa.binary()),
            "graph": pa.array([pickle.dumps((graph.entry, graph.layers))], pa.binary()),
        })

    index = written(
        classes.select(
            F.size("v").alias("size"), F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"),
            "rep", "copies", "v",
        ).groupBy("size", "shard").applyInArrow(
            built, "size int, shard int, vectors binary, graph binary"
        ),
        "embedding-graphs",
    )

    def asked(key, table):
        ids, copies, matrix = pickle.loads(table.column("vectors")[0].as_py())
        graph = Graph.__new__(Graph)
        graph.entry, graph.layers = pickle.loads(table.column("graph")[0].as_py())
        own, held, queries = pickle.loads(table.column("queries")[0].as_py())
        exact = unit(matrix)
        graph.vectors = exact.astype(np.float32)
        asking, cross = unit(queries), key[1] != key[2]
        nodes = np.unique(np.concatenate([own, ids]))
        left, right = np.searchsorted(nodes, own), np.searchsorted(nodes, ids)
        forest, links, tally = Forest(len(nodes)), np.zeros(len(nodes), np.int64), np.zeros(len(own), int)
        for q, x in links_of(graph, exact, asking, least):
            tally += np.bincount(q, minlength=len(own))
            other = left[q] != right[x]
            q, x = q[other], x[other]
            np.add.at(links, left[q], copies[x])
            if cross:
                np.add.at(links, right[x], held[q])
            forest.add(left[q], right[x])
        some, hung = np.flatnonzero(links), np.flatnonzero(forest.label != np.arange(len(nodes)))
        recall = recall_of(tally, exact, asking, least)
        a = [*nodes[some].tolist(), *nodes[hung].tolist(), None]
        b = [*(None for _ in some), *nodes[forest.label[hung]].tolist(), None]
        n = [*links[some].tolist(), *(None for _ in hung), None]
        return pa.table({
            "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64()),
            "recall": pa.array([None] * (len(a) - 1) + [recall], pa.float64()),
        })

    blocks = index.select("size", F.col("shard").alias("block"), F.col("vectors").alias("queries"))
    blocks = blocks.withColumn("shard", F.explode(F.sequence("block", F.lit(shards - 1))))
    cells = blocks.join(index.hint("merge"), ["size", "shard"]).repartition(
        min(shards * (shards + 1) // 2, 4096), "size", "shard", "block"
    )
    answers = written(
        cells.groupBy("size", "shard", "block").applyInArrow(
            asked, "a bigint, b bigint, n bigint, recall double"
        ),
        "embedding-answers",
    )
    counts = answers.where("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    found = components(answers.where("b is not null").select("a", "b"))
    named = classes.join(hinted(counts), classes["rep"] == counts["a"], "left").join(
        hinted(found), classes["rep"] == found["node"], "left"
    ).select(
        "k1", "k2", "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    named = hinted(written(named, "embedding-classes"))
    fits = (rows["k1"] == named["k1"]) & (rows["k2"] == named["k2"]) & rows["v"].isNotNull()
    result = rows.join(named, fits, "left")
    result = result.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
    return result, answers.where("recall is not null").select("recall")
