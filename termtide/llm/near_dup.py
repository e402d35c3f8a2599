"""Near duplicates by SuperMinHash signatures, banding, exact verification and union-find."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.components import components
from termtide.llm.tables import fresh, give_back, hinted, written
from termtide.llm.textscan import mixed, pieces, shingles_of, texts_of

BANDS, ROWS = 42, 6
WIDTH = BANDS * ROWS
PIECE = 1 << 19
#: Members of a bucket that one task compares with so many others at most.
BLOCK = 512
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def super_minhash(row: np.ndarray, value: np.ndarray, n: int, width: int = WIDTH) -> np.ndarray:
    """Signatures of ``n`` sets, given as (set, 64-bit value) pairs in order of the set.

    Each value has a random permutation of the places of a signature, and visits them in turn: in
    step j it offers j plus a fraction of its own to its j-th place, which keeps the least offer.
    So one place's offers are correlated with the others', which lowers the variance. An offer of
    a later step is always higher, so a set is done once each place has one: after a step or two
    for a long text. All sets take a step at once.
    """
    out = np.full(n * width, _EMPTY, np.uint64)
    place = np.tile(np.arange(width, dtype=np.uint8 if width <= 256 else np.uint16), (len(value), 1))
    row, value = row.astype(np.int64), value.copy()
    for j in range(width):
        if not len(value):
            break
        draw = mixed(value + np.uint64(0x632BE59BD9B4E019 * (j + 1) % (1 << 64)))
        pick = j + (mixed(draw) % np.uint64(width - j)).astype(np.int64)
        every = np.arange(len(value))
        at = place[every, pick].astype(np.int64)
        place[every, pick] = place[:, j]
        offer = (np.uint64(j) << np.uint64(54)) | (draw >> np.uint64(10))
        np.minimum.at(out, row * width + at, offer)
        done = (out.reshape(n, width) != _EMPTY).all(axis=1)
        left = ~done[row]
        if not left.all():
            row, value, place = row[left], value[left], place[left]
    return out.reshape(n, width)


def folded(columns: np.ndarray, seed: int) -> np.ndarray:
    """One hash per row of a matrix of 64-bit values."""
    total = np.full(len(columns), mixed(np.array([seed], np.uint64))[0], np.uint64)
    for column in columns.T:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + column)
    return total


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    cuts = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(cuts), signed(values.ravel()))


def binaries(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Stretches of a byte array, from each cut to the next."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(cuts) - 1,
        [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())],
    ).cast(pa.binary())


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc, n (shingles), f1 and f2 (fingerprint of the set), bands (hashes), sketch (bytes)."""

    def sketched(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                row, value = shingles_of(texts_of(piece.column("text")), words)
                n = piece.num_rows
                marks = np.zeros((2, n), np.uint64)
                for i in range(2):
                    np.add.at(marks[i], row, mixed(value ^ np.uint64(0x5851F42D4C957F2D * (i + 1) % (1 << 64))))
                signature = super_minhash(row, value, n)
                keys = np.stack(
                    [folded(signature[:, i * ROWS : (i + 1) * ROWS], i) for i in range(BANDS)], axis=1
                )
                low = (mixed(signature) & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc"), pa.array(np.bincount(row, minlength=n)),
                        signed(marks[0]), signed(marks[1]), lists(keys),
                        binaries(low.ravel(), np.arange(n + 1) * WIDTH),
                    ],
                    ["doc", "n", "f1", "f2", "bands", "sketch"],
                )
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        sketched, "doc bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>, sketch binary"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc and its shingles, as sorted 64-bit hashes, of the wanted ids."""

    def hashed(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                row, value = shingles_of(texts_of(piece.column("text")), words)
                cuts = np.searchsorted(row, np.arange(piece.num_rows + 1)) * 8
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), binaries(value.view(np.uint8), cuts)], ["doc", "shingles"]
                )
        give_back()

    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return texts.join(hinted(wanted), "doc", "left_semi").mapInArrow(
        hashed, "doc bigint, shingles binary"
    )


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Do two sets share that percentage of their union or more?"""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def linked(
    docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, words: int, percent: int
) -> DataFrame:
    """Of pairs (a, b), those whose full sets share that percentage of their union or more."""

    def bytes_to_set(x):
        return np.frombuffer(x.as_py(), np.uint64)

    def verified(batches):
        for batch in batches:
            sides = (map(bytes_to_set, batch.column(c)) for c in ("of_a", "of_b"))
            keep = [alike(x, y, percent) for x, y in zip(*sides)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    sets = written(full_sets(docs, written(ids, "dup-ids"), id_col, text_col, words), "dup-sets")
    first = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b")
    return both.select("a", "b", "of_a", "of_b").mapInArrow(verified, "a bigint, b bigint")


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within buckets that connect what wasn't connected yet.

    ``members``: bucket, x, y (blocks), side, doc, component, sketch, shingles. Each (bucket, x, y) is
    one pair of blocks of bounded size; a task takes one after the other from its sorted rows.
    Pairs in different components whose sketches don't rule them out are verified on their full
    sets, the likeliest first, until a link connects their components.
    """
    share = percent / 100
    least = (share - 4.5 * (share * (1 - share) / WIDTH) ** 0.5) * WIDTH

    def compared(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "x", "y")], axis=1)
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
            if last:
                yield from groups(table.slice(0, last), keys[:last])
                held = table.slice(last).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "x", "y")], axis=1)
            yield from groups(table, keys)
            held, table, batch = [], None, None
        give_back()

    def groups(table, keys):
        cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
        doc, comp, side = (table.column(c).to_numpy() for c in ("doc", "component", "side"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, WIDTH)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        links = []
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            left = a + np.flatnonzero(side[a:b] == 1)
            right = a + np.flatnonzero(side[a:b] == 0)
            for i, j in likely(sketch, comp, left, right):
                if top(comp[i]) != top(comp[j]) and alike(sets[i], sets[j], percent):
                    parent[max(top(comp[i]), top(comp[j]))] = min(top(comp[i]), top(comp[j]))
                    links.append((doc[i], doc[j]))
        pairs = np.array(links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))],
            ["a", "b"],
        )

    def likely(sketch, comp, left, right):
        found = []
        for at in range(0, len(left), 16):
            part = left[at : at + 16]
            same = (sketch[part][:, None, :] == sketch[right][None, :, :]).sum(axis=2)
            i, j = np.nonzero((same >= least) & (comp[part][:, None] != comp[right][None, :]))
            found.append(np.stack([part[i], right[j], same[i, j]]))
        if not found:
            return
        i, j, same = np.concatenate(found, axis=1)
        for at in np.argsort(-same, kind="stable"):
            yield i[at], j[at]

    parent: dict[int, int] = {}

    def top(x):
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    rows = members.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    return rows.mapInArrow(compared, "a bigint, b bigint").distinct()


def blocks_of(inside: DataFrame) -> DataFrame:
    """Where members of open buckets are compared: bucket, x, y, side, doc, component.

    ``inside`` has bucket, size, doc and component. Members of a bucket's largest component are connected
    already; only the others need a look at all members. All members are residents (side 0) of the
    blocks (x, y) of their own x and every y, the others visitors (side 1) of those of their own y and every
    x. So a block holds some two times BLOCK rows, and one odd document in a bucket of n makes
    n + n / BLOCK of them.
    """
    sizes = inside.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    sizes = sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", -F.col("component"))).alias("main"),
        F.ceil(F.max("size") / BLOCK).cast("int").alias("xs"),
        F.ceil((F.max("size") - F.max("n")) / BLOCK).cast("int").alias("ys"),
    )
    rows = inside.select("bucket", "doc", "component").join(hinted(written(sizes, "dup-sizes")), "bucket")
    own = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    residents = rows.select("bucket", own("xs").alias("x"), every("ys").alias("y"), F.lit(0).alias("side"), "doc", "component")
    visitors = rows.where("component <> main").select(
        "bucket", every("xs").alias("x"), own("ys").alias("y"), F.lit(1).alias("side"), "doc", "component"
    )
    return residents.unionByName(visitors)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc, n_shingles, component (long), kept.

    Documents are linked if their sets of ``words``-word shingles share ``percent`` of their union
    or more; A-Z count as lower case, fewer words are one shingle. A component is named by its
    smallest id, which is the one kept. Documents without words are alone. Rows of one id are one
    document, whose texts are all in its component. A null id has a null component and is kept. An
    empty table gives no rows. Other columns are not read.

    1. Texts of equal sets are one class, so exact copies cost a row each and no pair.
    2. In each bucket of a band all members are verified against the smallest and the largest id:
       two pairs a member, however large the bucket.
    3. Buckets of four members or more that still hold several components are compared whole,
       block by block, within tasks: pairs that aren't connected yet and that their sketches don't
       rule out are verified there. Thus every pair that shares a bucket is verified, ruled out
       by its sketch, or connected already; none of these pairs becomes a row.

    Two documents at 80 % miss all 42 bands of 6 with a probability of about 3 in a million, and
    less above; a sketch rules out a pair at ``percent`` (4.5 standard deviations) about as rarely.
    """
    sketched = written(sketches(docs, id_col, text_col, words), "dup-sketches")
    known = sketched.where("n > 0 and doc is not null")
    classes = known.groupBy("f1", "f2", "n").agg(F.min("doc").alias("rep"))
    members = written(
        known.select("doc", "f1", "f2", "n").join(hinted(written(classes, "dup-classes")), ["f1", "f2", "n"])
        .select("doc", "rep", "f1", "f2"),
        "dup-members",
    )
    leaders = members.where("doc = rep").select("doc", "f1", "f2").distinct()
    leading = known.join(hinted(leaders), ["doc", "f1", "f2"], "left_semi")
    keyed = leading.select("doc", F.explode("bands").alias("key"))
    # A hot bucket reaches the minimum as a row a task, and the join in parts that AQE cuts.
    ends = keyed.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    buckets = written(keyed.join(hinted(written(ends, "dup-ends")), "key"), "dup-buckets")
    ends = F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("doc").alias("b")),
                             F.struct(F.col("doc").alias("a"), F.col("high").alias("b"))))
    pairs = buckets.select(ends.alias("p")).select("p.a", "p.b").where("a < b").distinct()
    pairs = written(pairs, "dup-pairs")
    links = linked(docs, pairs, id_col, text_col, words, percent)
    versions = members.groupBy("doc").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x < y")
    own = members.join(versions, "doc", "left_semi").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    links = written(links.unionByName(own), "dup-links")
    found = components(links)

    placed = buckets.join(hinted(found), buckets["doc"] == found["node"], "left").select(
        "key", "doc", F.coalesce("component", "doc").alias("component")
    )
    mixed_ = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("c1"), F.max("component").alias("c2"),
        F.bit_xor(F.xxhash64("doc")).alias("mark"), F.min("doc").alias("first"),
    ).where("size > 3 and c1 < c2")
    # Buckets of the same members are one.
    mixed_ = mixed_.groupBy("size", "mark", "first").agg(F.min("key").alias("bucket"))
    open_ = written(mixed_.select("bucket", "size"), "dup-open")
    if not open_.isEmpty():
        inside = blocks_of(placed.join(hinted(open_), placed["key"] == open_["bucket"]))
        inside = written(inside, "dup-blocks")
        ids = written(inside.select("doc").distinct(), "dup-ids")
        sets = full_sets(docs, ids, id_col, text_col, words)
        sets = sets.distinct().join(leading.select("doc", "sketch").distinct(), "doc")
        inside = inside.join(written(sets, "dup-sets").hint("merge"), "doc").select(
            "bucket", "x", "y", "side", "doc", "component", "sketch", "shingles"
        )
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(written(block_links(inside, percent).unionByName(stars), "dup-links"))

    named = members.join(hinted(found), members["rep"] == found["node"], "left").select(
        "doc", F.coalesce("component", "rep").alias("component")
    ).groupBy("doc").agg(F.min("component").alias("component"))
    result = sketched.select("doc", F.col("n").alias("n_shingles")).join(named, "doc", "left")
    component = F.coalesce("component", "doc")
    return result.select(
        "doc", "n_shingles", component.alias("component"), component.eqNullSafe(F.col("doc")).alias("kept")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that `near_duplicates` keeps, each id once; null ids all stay. Other
    columns may have any names."""
    judged = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    [doc] = fresh(docs, "doc")
    gone = judged.where("not kept").select(F.col("doc").alias(doc)).distinct()
    twice = F.col(f"`{id_col}`").cast("long") == F.col(doc)
    rows = docs.join(hinted(written(gone, "dup-gone")), twice, "left_anti")
    again = judged.groupBy(F.col("doc").alias(doc)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(again.where(F.col(doc).isNotNull()).select(doc), "dup-again")
    if again.isEmpty():
        return rows
    single = rows.join(hinted(again), twice, "left_anti")
    return single.unionByName(rows.join(hinted(again), twice, "left_semi").dropDuplicates([id_col]))
