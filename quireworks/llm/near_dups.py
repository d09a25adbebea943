"""Operator 3: near duplicates by a signature-coordinate inverted join.

A document's set of shingles has a signature of COORDINATES minima. Documents are posted
under pairs of coordinate and minimum. In any one order of all pairs, two documents that
agree in ``matches(percent)`` coordinates share one of their first COORDINATES - matches + 1,
so only those are posted, the rare ones first: what a line that many documents hold gives
comes last. Pairs that meet are counted over whole signatures, kept from ``matches`` on, and
confirmed on whole sets.

Lists are merged by skipping: equal sets are one node; every node is first compared with
one central member of its lists only; lists whose members are connected by then are
skipped, and in the others only members of different components are compared. First by
signatures, list by list: which components agree in enough coordinates makes them a
family. Then by whole sets, family by family, block by block, until they are united. So a
group of copies costs its size, not its square, and no link between components is lost;
what still costs its square is a group of texts that are nearly but not quite similar
enough, since each pair of them must be refuted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.llm.common import as_bytes, cut, map_batches, release, settled, spread_table
from quireworks.llm.components import components
from quireworks.llm.words import Texts, mix, windows
from quireworks.session import materialize

SHINGLE = 4
PERCENT = 80
COORDINATES = 63
MISSED = 3e-6  # the most probability that a pair at the threshold is missed
_PER_LONG = 7  # bytes of signature in a long, so that sums don't overflow
_LONGS = COORDINATES // _PER_LONG
_SLICE = 2 << 20
_LIST_BLOCK = 2048  # members of a list that are compared by signatures in one go
_FAMILY_BLOCK = 256  # documents of a block in the last comparison, at most about
_FAMILY_HASHES = 1 << 21  # and hashes of their sets
_BUCKETS = 1 << 16  # counters of the sketch that orders pairs of coordinate and minimum
_rng = np.random.default_rng(7)
_A = _rng.integers(1, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDINATES, np.uint64)


def matches(percent: int) -> int:
    """In how many coordinates a pair must agree to be compared (80 percent: 35 of 63).

    A pair at the threshold agrees in each with probability percent / 100; the number is the
    largest that fewer reach with a probability of MISSED at most.
    """
    p, below = percent / 100, 0.0
    for m in range(COORDINATES + 1):
        below += math.comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
        if below > MISSED:
            break
    if not (m and percent <= 100):
        raise ValueError(f"{percent} percent: pairs can be found from 19 to 100 percent")
    return m


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; shorter texts are one shingle."""
    words = Texts(texts, lower=True)
    hashes = words.hashes()
    runs = windows(hashes, size)
    out = []
    for begin, end in zip(words.first[:-1], words.first[1:]):
        if end - begin >= size:
            out.append(np.unique(runs[begin : end - size + 1]))
        elif end > begin:
            out.append(windows(hashes[begin:end], int(end - begin)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return bool(len(a) and len(b) and 100 * shared >= percent * (len(a) + len(b) - shared))


def digest() -> Column:
    """A hash of doc_id and text, 16 bytes; nulls are values of their own."""
    name = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string"), F.lit(":")), F.lit("n:"))
    text = F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("n"))
    return F.unhex(F.md5(F.concat(name, text).cast("binary")))


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, n, h1, h2, minima): two hashes of the whole set, and its signature."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, h1, h2, minima = [], [], [], []
        for part in cut(batch, 2, _SLICE):
            sets = shingle_sets(part.column(2).to_pylist(), size)
            counts = np.array(list(map(len, sets)), np.int64)
            n.append(counts)
            some = np.flatnonzero(counts)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            begins = (np.cumsum(counts) - counts)[some]
            least = np.zeros((len(sets), COORDINATES), np.uint64)
            sums = np.zeros((2, len(sets)), np.uint64)
            if len(some):
                for k in range(COORDINATES):
                    least[some, k] = np.minimum.reduceat(flat * _A[k] + _B[k], begins)
                for k in range(2):
                    sums[k, some] = np.add.reduceat(mix(flat + np.uint64(k + 1)), begins)
            h1.append(sums[0].view(np.int64))
            h2.append(sums[1].view(np.int64))
            minima += [row.tobytes() for row in least]
        numbers = [pa.array(np.concatenate(x)) for x in (n, h1, h2)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], *numbers, pa.array(minima, pa.binary())],
            names=["doc_id", "digest", "n", "h1", "h2", "minima"],
        )

    schema = "doc_id long, digest binary, n long, h1 long, h2 long, minima binary"
    return map_batches(docs.select("doc_id", digest().alias("digest"), as_bytes("text").alias("text")), work, schema)


def _keys(column: pa.Array) -> np.ndarray:
    """A hash of coordinate and minimum, for each coordinate of each signature."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, COORDINATES)
    return mix(rows ^ mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)))


def pair_counts(nodes: DataFrame) -> np.ndarray:
    """How often pairs of coordinate and minimum occur, by bucket of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            bucket = _keys(batch.column(0)) % np.uint64(_BUCKETS)
            total += np.bincount(bucket.ravel().astype(np.int64), minlength=_BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = nodes.select("minima").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(_BUCKETS, np.int64)
    for row in found.collect():  # at most _BUCKETS rows, whatever the documents
        out[row["bucket"]] = row["n"]
    return out


def _posts(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, doc): a row for each of the rarest pairs of each node, as many as ``matches`` asks."""
    prefix = COORDINATES - matches(percent) + 1
    counts = pair_counts(nodes)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = _keys(batch.column(1))
        rare = counts[(keys % np.uint64(_BUCKETS)).astype(np.int64)]
        order = np.lexsort((keys, rare), axis=1)[:, :prefix]  # one order for all nodes
        posted = np.take_along_axis(keys, order, 1)
        doc = np.repeat(batch.column(0).to_numpy(), prefix)
        return pa.RecordBatch.from_arrays(
            [pa.array(posted.ravel().view(np.int64)), pa.array(doc)], names=["key", "doc"]
        )

    return map_batches(nodes.select("doc", "minima"), work, "key long, doc long")


def _packed(nodes: DataFrame) -> DataFrame:
    """(doc, n, q0..): signatures of a byte for each coordinate, seven to a number."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        small = (_keys(batch.column(2)) >> np.uint64(20)) & np.uint64(0xFF)
        shift = np.uint64(8) * np.arange(_PER_LONG, dtype=np.uint64)
        packed = [
            (small[:, k : k + _PER_LONG] << shift).sum(1, dtype=np.uint64).view(np.int64)
            for k in range(0, COORDINATES, _PER_LONG)
        ]
        names = ["doc", "n", *(f"q{k}" for k in range(_LONGS))]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *map(pa.array, packed)], names=names)

    schema = "doc long, n long, " + ", ".join(f"q{k} long" for k in range(_LONGS))
    return map_batches(nodes.select("doc", "n", "minima"), work, schema)


def _agreements(a: str, b: str) -> Column:
    """In how many coordinates two packed signatures agree (bytes of the xor that are zero)."""
    low, high = F.lit(0x007F7F7F7F7F7F7F), F.lit(0x0080808080808080)
    differ = None
    for k in range(_LONGS):
        x = F.col(f"{a}.q{k}").bitwiseXOR(F.col(f"{b}.q{k}"))
        marked = (x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high)
        count = F.bit_count(marked)
        differ = count if differ is None else differ + count
    return F.lit(COORDINATES) - differ


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity, and enough agreements."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = (100 * n >= percent * m) & (100 * m >= percent * n)
    return sizes & (_agreements(a, b) >= matches(percent))


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar; texts has (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            for part in cut(batch, 2, _SLICE):
                u, v, one, other = (c.to_pylist() for c in part.columns)
                sets = shingle_sets(one, size)
                good = []
                for i, text in enumerate(other):
                    if text != last:
                        last, known = text, shingle_sets([text], size)[0]
                    if similar(sets[i], known, percent):
                        good.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for i in good], pa.int64()) for x in (u, v)], names=["u", "v"]
                )

    first = texts.select(F.col("doc").alias("u"), F.col("text").alias("one"))
    second = texts.select(F.col("doc").alias("v"), F.col("text").alias("other"))
    joined = pairs.join(first, "u").join(second, "v").select("u", "v", "one", "other")
    return joined.mapInArrow(run, "u long, v long")


def _agreeing(
    packed: np.ndarray, n: np.ndarray, u: int, others: np.ndarray, percent: int, least: int
) -> np.ndarray:
    """Those of the others that ``_may_link`` to row u; ``least`` is ``matches(percent)``."""
    others = others[(100 * n[others] >= percent * n[u]) & (100 * n[u] >= percent * n[others])]
    low, high = np.int64(0x007F7F7F7F7F7F7F), np.int64(0x0080808080808080)
    differ = packed[others] ^ packed[u]
    marked = ((differ & low) + low | differ) & high
    return others[COORDINATES - np.bitwise_count(marked).sum(1, dtype=np.int64) >= least]


def _list_candidates(part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of components with agreeing rows in two blocks of a list (or one), no more than unite them.

    ``part`` has columns block, x, y, component, n, q0...; components that such pairs
    connect already are not compared again.
    """
    block, x, y, component, n = part[:, :5].T
    packed = part[:, 5:]
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    name, least = component.copy(), matches(percent)
    found = []
    for u in left:
        others = right[right > u] if x[0] == y[0] else right
        others = others[name[others] != name[u]]
        if len(others):
            agreeing = _agreeing(packed, n, u, others, percent, least)
            for other, at in zip(*np.unique(name[agreeing], return_index=True)):
                found.append((int(component[u]), int(component[agreeing[at]])))
                name[name == other] = name[u]
    return found


def _candidates(posts: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components that have agreeing members in a list.

    A list is cut into blocks of about _LIST_BLOCK members, and each pair of blocks meets in
    one task with signatures only. Components that agree are connected by the links, though
    not each with each.
    """
    columns = ["block", "x", "y", "component", "n", *(f"q{k}" for k in range(_LONGS))]
    cut_up = posts.withColumn("blocks", F.ceil(F.col("members") / _LIST_BLOCK))
    cut_up = cut_up.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = cut_up.withColumn("other", other).withColumns(
        {"x": F.least("block", "other"), "y": F.greatest("block", "other")}
    )
    paired = paired.select("key", *columns).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, len(columns) + 1), np.int64)

        def links(rows: np.ndarray, bounds: list[int]) -> pa.RecordBatch:
            found = set()
            for begin, end in zip(bounds[:-1], bounds[1:]):
                found.update(_list_candidates(rows[begin:end, 1:], percent))
            return pa.RecordBatch.from_arrays(
                [pa.array([pair[k] for pair in found], pa.int64()) for k in range(2)], names=["u", "v"]
            )

        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], 1)])
            changes = np.any(rows[1:][:, [0, 2, 3]] != rows[:-1][:, [0, 2, 3]], axis=1)
            bounds = [0, *(np.flatnonzero(changes) + 1).tolist()]
            yield links(rows, bounds)
            held = rows[bounds[-1] :]
        yield links(held, [0, len(held)] if len(held) else [0])

    return paired.mapInArrow(run, "u long, v long")


def _first_links(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between the rows of two blocks (or within one) that unite components.

    A row is compared with those of other components that agree with it in enough
    coordinates; a confirmed link unites two components, whose other pairs are skipped.
    """
    doc, component, n = (table[c].to_numpy() for c in ("doc", "component", "n"))
    block, x, y = (table[c].to_numpy() for c in ("block", "x", "y"))
    packed = np.stack([table[f"q{k}"].to_numpy() for k in range(_LONGS)], 1)
    sets = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
    sizes = np.array(list(map(len, sets)))
    begins = np.cumsum(sizes) - sizes
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    name = np.unique(component, return_inverse=True)[1]
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    mark, least = np.zeros(len(codes), bool), matches(percent)
    found = []
    for u in left:
        others = right[right > u] if x[0] == y[0] else right
        others = _agreeing(packed, n, u, others[name[others] != name[u]], percent, least)
        if not len(others):
            continue
        own = codes[begins[u] : begins[u] + sizes[u]]
        mark[own] = True
        at = np.repeat(begins[others] - (np.cumsum(sizes[others]) - sizes[others]), sizes[others])
        at += np.arange(len(at))
        shared = np.add.reduceat(mark[codes[at]], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        mark[own] = False
        for v in others[100 * shared >= percent * (sizes[u] + sizes[others] - shared)]:
            if name[u] != name[v]:
                found.append((int(doc[u]), int(doc[v])))
                name[name == name[v]] = name[u]
    return found


def _family_blocks(members: DataFrame) -> DataFrame:
    """(family, blocks): so many that a block has few documents and few hashes, however long the texts."""
    documents, hashes = F.count(F.lit(1)) / _FAMILY_BLOCK, F.sum("n") / _FAMILY_HASHES
    return members.groupBy("family").agg(F.ceil(F.greatest(documents, hashes)).alias("blocks"))


def _link_families(posts: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (u, v) that unite components of the posted documents.

    Components with agreeing members, directly or by others, are a family. A family is cut
    into blocks, and each pair of blocks meets in one task with its whole sets: a document
    travels once for each block, not for each pair, and only uniting links come out.
    """
    qs = [f"q{k}" for k in range(_LONGS)]
    families = components(_candidates(posts, percent))
    families = families.select(F.col("component").alias("family"), F.col("node").alias("component"))
    members = settled(posts.select("doc", "component", "n", *qs).distinct().join(families, "component"))
    blocks = _family_blocks(members)
    release(posts.sparkSession)

    def hash_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for part in cut(batch, 1, _SLICE):
            out += [x.tobytes() for x in shingle_sets(part.column(1).to_pylist(), size)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc", "hashes"])

    wanted = texts.join(members.select("doc"), "doc", "left_semi").select("doc", "text")
    hashed = map_batches(wanted, hash_sets, "doc long, hashes binary")
    members = members.join(blocks, "family").join(hashed, "doc").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = members.withColumn("other", other).select(
        "family", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "doc", "component", "n", *qs, "hashes",
    )

    def link(table: pa.Table) -> pa.Table:
        found = _first_links(table, percent)
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return paired.groupBy("family", "x", "y").applyInArrow(link, "u long, v long")


def _linked_classes(docs: DataFrame, size: int, percent: int, with_null_ids: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, digest, n, h1, h2, minima), and classes (n, h1, h2, doc, doc_id, digest, component).

    A class is the rows of equal sets, with a number ``doc`` of its own and its smallest
    doc_id (null last) with a text's digest. Linked classes are one component, named by
    one of their numbers. Rows without shingles, or without doc_id if so asked, have none.
    """
    matches(percent)  # refuses what it can't find
    rows, _ = materialize(signatures(docs, size), "signatures")
    key = ["n", "h1", "h2"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "minima")).alias("r")
    classes = settled(
        rows.filter("n > 0" if with_null_ids else "n > 0 AND doc_id IS NOT NULL")
        .groupBy(*key)
        .agg(first)
        .select(*key, F.monotonically_increasing_id().alias("doc"), "r.doc_id", "r.digest", "r.minima")
    )
    posts = _posts(classes, percent)
    lists = posts.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    posts = settled(posts.join(lists, "key"))
    members = posts.select("doc").distinct()
    posts = settled(posts.join(_packed(classes).join(members, "doc", "left_semi"), "doc"))

    # A text of every class that shares a list, once, for the confirmations.
    wanted = classes.select("doc", "digest").join(members, "doc", "left_semi")
    texts, _ = materialize(
        docs.select(digest().alias("digest"), as_bytes("text").alias("text"))
        .join(wanted, "digest")
        .groupBy("digest")
        .agg(F.first("doc").alias("doc"), F.first("text").alias("text"))
        .select("doc", "text"),
        "members",
    )

    release(docs.sparkSession)

    # Each node against one member of its lists: the one that shares most lists with most nodes.
    rank = F.struct("weight", (-F.col("doc")).alias("less"), *(F.col(f"q{k}") for k in range(_LONGS)), "n")
    weights = posts.groupBy("doc").agg(F.sum("members").alias("weight"))
    weighed = posts.join(weights, "doc")
    central = weighed.groupBy("key").agg(F.max(rank).alias("r"))
    qs = [f"q{k}" for k in range(_LONGS)]
    hubs = central.select("key", "r.weight", (-F.col("r.less")).alias("doc"), "r.n", *(f"r.{q}" for q in qs))
    met = weighed.alias("a").join(hubs.alias("b"), "key").filter("a.doc <> b.doc").filter(_may_link("a", "b", percent))
    best = (
        met.groupBy(F.col("a.doc").alias("u"))
        .agg(F.max(F.struct(_agreements("a", "b").alias("same"), "b.weight", (-F.col("b.doc")).alias("less"))).alias("r"))
        .select("u", (-F.col("r.less")).alias("v"))
    )
    links = settled(_confirm(best, texts, size, percent))
    found = settled(components(links))
    release(docs.sparkSession)

    # What is left: lists whose members are not all connected, across components.
    placed = posts.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    open_ = settled(placed.join(mixed.select("key"), "key"))
    more = _link_families(open_, texts, size, percent)
    united = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))
    placed = classes.drop("minima").join(united.withColumnRenamed("node", "doc"), "doc", "left")
    return rows, settled(placed.withColumn("component", F.coalesce("component", "doc")))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for documents (doc_id, text).

    Two documents are linked if 100 * shared >= ``percent`` (19 to 100) * united shingles; a component
    is named by its smallest doc_id. Null and empty texts have no shingles and no links.
    Rows that repeat a doc_id are one node with the links of all its texts. A null doc_id
    links to nothing: component null, kept. Empty tables give no rows; other columns are
    ignored.
    """
    rows, classes = _linked_classes(docs, size, percent, with_null_ids=False)
    key = ["n", "h1", "h2"]
    known = rows.filter("doc_id IS NOT NULL").select("doc_id", *key)

    # Ids whose rows differ, linked to each of their classes.
    differ = [f(k) for k in key for f in (F.min, F.max)]
    several = known.groupBy("doc_id").agg(*(x.alias(f"x{i}") for i, x in enumerate(differ)))
    several = several.filter("x0 <> x1 OR x2 <> x3 OR x4 <> x5").select("doc_id")
    placed = known.join(several, "doc_id").join(classes.select(*key, "component"), key)
    placed = settled(placed.select("doc_id", "component").distinct())
    least = placed.groupBy("doc_id").agg(F.min("component").alias("v"))
    again = components(placed.join(least, "doc_id").select(F.col("component").alias("u"), "v"))
    again = settled(again.select(F.col("node").alias("component"), F.col("component").alias("whole")))
    whole = F.coalesce("whole", "component").alias("component")
    classes = classes.join(again, "component", "left").select(*key, "doc_id", whole)
    names = classes.groupBy("component").agg(F.min("doc_id").alias("found"))
    of_class = classes.join(names, "component").select(*key, "found")
    of_id = least.withColumnRenamed("v", "component").join(again, "component", "left").select("doc_id", whole)
    of_id = of_id.join(names, "component").select("doc_id", "found")

    # Rows without shingles go with the other rows of their id.
    found = known.filter("n > 0").join(of_class, key, "left").select("doc_id", "n", "found")
    found = found.unionByName(known.filter("n = 0").join(of_id, "doc_id", "left").select("doc_id", "n", "found"))
    nulls = rows.filter("doc_id IS NULL").select("doc_id", "n", F.lit(None).cast("long").alias("found"))
    return found.unionByName(nulls).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("found", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("found", "doc_id"), F.lit(True)).alias("kept"),
    )


def first_texts(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of documents without near duplicates: one row for each group of linked texts.

    Here each text is a document of its own: several texts under one doc_id are linked
    only if they are similar, and one without doc_id is linked like any other. A group keeps
    the row of its smallest doc_id, null last, and under that id the text of the smallest
    digest. Texts without shingles have no links. Of rows with equal doc_id and text one is
    kept, whatever their other columns.
    """
    rows, classes = _linked_classes(docs, size, percent, with_null_ids=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("r")
    kept = classes.groupBy("component").agg(first).select("r.digest")
    kept = kept.unionByName(rows.filter("n = 0").select("digest").distinct())
    once = (
        docs.select(digest().alias("digest"), F.struct("*").alias("row"), F.xxhash64("*").alias("tie"))
        .groupBy("digest")
        .agg(F.min_by("row", "tie").alias("row"))
    )
    return once.join(kept, "digest", "left_semi").select("row.*")


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of all documents."""
    return near_duplicates(spread_table(spark, sf_dir, "documents"))


OP3_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {SHINGLE - 1}, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION SELECT reach.doc_id, b.y FROM reach JOIN both_ways b ON b.x = reach.c),
least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT l.doc_id, coalesce(n.n, 0) AS n_shingles, l.component_id, l.doc_id = l.component_id AS kept
FROM least l LEFT JOIN n USING (doc_id)"""
