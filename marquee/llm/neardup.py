"""Near-duplicate groups by SetSketch registers: band, estimate by joint likelihood, verify on full sets.

A register is the truncated minimum of exponential hash values, on a scale of
powers of ``BASE``; registers of a union are the maxima of both, and two
registers agree about as often as the sets do.  Four registers form a band.

Documents with equal sets become one node.  Documents that share a band make a
bucket; within it

* every member is compared with the smallest one (no pairs but these), which
  links nearly all copies of a group however large it is;
* buckets whose members then still belong to different components are compared
  in blocks of bounded size, only across components.

Pairs are estimated from the registers and all that may reach the threshold are
confirmed on the full shingle sets, so no link that a band has found is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import keyed, saved
from marquee.llm.graph import components
from marquee.llm.shingles import batches_of, common, parts_of, shingle_sets

ROWS, BANDS = 4, 32
M = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, 65_535
BLOCK = 256  # members of a bucket that are compared at once
# Five standard deviations of an estimate from 128 registers below 0.75.
MARGIN = 0.19

_rng = np.random.default_rng(1203)
_XOR = _rng.integers(0, 2**64 - 1, M, dtype=np.uint64)
_MUL = _rng.integers(0, 2**63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SKETCH = "doc_id long, node long, n int, h1 long, h2 long, regs array<long>"


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (sets x M, 16 bits) of non-empty sets of 64-bit hashes."""
    if not sets:
        return np.empty((0, M), np.uint16)
    all_, at = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((M, len(sets)), np.uint64)
    for i in range(M):
        least[i] = np.minimum.reduceat((all_ ^ _XOR[i]) * _MUL[i], at)
    u = (least.T.astype(np.float64) + 1) / 2.0**64
    h = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.ascontiguousarray(np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, TOP).astype(np.uint16))


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers ``x`` and ``y`` whose sets have ``n`` and ``m`` elements, by maximum
    likelihood of how many registers are larger, smaller and equal."""
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    same = x.shape[1] - more - less
    u = n / (n + m)
    v = 1 - u
    p = lambda t: -np.log1p(-np.clip(t, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        a, b = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return more * np.log(a) + less * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-12))

    low, high = np.zeros(len(n)), np.minimum(u / v, v / u)
    for _ in range(40):  # ternary search: the likelihood has one maximum
        third = (high - low) / 3
        left = log_likelihood(low + third) < log_likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def _as_registers(column: pa.Array) -> np.ndarray:
    """Rows of registers from a column of arrays of 64-bit band values."""
    return column.flatten().to_numpy().view(np.uint16).reshape(-1, M)


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, two set hashes and the registers (a 64-bit value per band) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 500):
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for a, b in batches_of(texts):
                sets = shingle_sets(texts[a:b])
                full = [s for s in sets if len(s)]
                bands = iter(registers(full).view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    pa.array([int(np.bitwise_xor.reduce((s + np.uint64(s.size)) * _MUL[0]).view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                    pa.array([next(bands) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ], names=[c.split()[0] for c in SKETCH.split(", ")])

    return docs.mapInArrow(run, SKETCH)


def likely(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose registers leave it possible that the sets reach the threshold."""
    side = lambda s: reps.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c = {k: batch.column(k) for k in batch.schema.names}
                j = estimate(_as_registers(c["regs_a"]), _as_registers(c["regs_b"]), c["n_a"].to_numpy(), c["n_b"].to_numpy())
                keep = pa.array(j >= threshold - MARGIN)
                yield pa.RecordBatch.from_arrays([c["a"].filter(keep), c["b"].filter(keep)], names=["a", "b"])

    sized = pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9)
    return sized.mapInArrow(run, "a long, b long")


def packed_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, z): the compressed texts of the given nodes, each once."""
    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 500):
            z = [zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(z, pa.binary())], names=["id", "z"])

    texts = docs.mapInArrow(squeeze, "id long, z binary").join(nodes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    return saved(texts.dropDuplicates(["id"]), "texts")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes with 100 * intersection >= percent * union, counted on the full sets of the whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 500):
            za, zb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for lo, hi in batches_of([x + y for x, y in zip(za, zb)], 1 << 19):
                own = {i: z for i, z in zip(a[lo:hi] + b[lo:hi], za[lo:hi] + zb[lo:hi])}
                sets = dict(zip(own, shingle_sets([zlib.decompress(z) for z in own.values()])))
                out += [(x, y) for x, y in zip(a[lo:hi], b[lo:hi]) if _linked(sets[x], sets[y], percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    full = pairs.join(texts.select(F.col("id").alias("a"), F.col("z").alias("za")), "a") \
        .join(texts.select(F.col("id").alias("b"), F.col("z").alias("zb")), "b").select("a", "b", "za", "zb")
    return saved(full.mapInArrow(run, "a long, b long"), "links")


def open_buckets(labelled: DataFrame) -> DataFrame:
    """(band, key, main, others, blocks) of the buckets with several components: the largest one, and how many blocks the
    rows outside and inside of it make."""
    each = labelled.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    sizes = each.groupBy("band", "key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("size"))
    return sizes.filter("size > most").select("band", "key", "main", F.ceil((F.col("size") - F.col("most")) / BLOCK).cast("int").alias("others"),
                                              F.ceil(F.col("most") / BLOCK).cast("int").alias("blocks"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of open buckets, once for every pair of blocks (bi <= bj) that they take part in; ``own`` is their block.

    Blocks 0 .. others - 1 hold the rows outside of the largest component and
    meet every block; the later ones hold its own rows and meet the former only.
    So a bucket of one component and a few strangers goes round as often as the
    strangers have blocks.
    """
    inside, hashed = F.col("component") == F.col("main"), F.xxhash64("rep")
    own = F.when(inside, F.col("others") + F.pmod(hashed, F.col("blocks"))).otherwise(F.pmod(hashed, F.col("others"))).cast("int")
    last = F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("blocks")) - 1
    return rows.withColumn("own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), last))) \
        .withColumn("bi", F.least("own", "_other")).withColumn("bj", F.greatest("own", "_other")).drop("_other", "main", "others", "blocks")


def _across(members: DataFrame, reps: DataFrame, texts: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links within a bucket whose ends lie in different components, from buckets in which some are left.

    A bucket is compared in pairs of blocks of bounded size; rows of its largest
    component are not compared with one another.  A pair is looked at in the first
    band that it shares; if its registers allow the threshold, its full sets
    are compared at once.  A task gives out no more links than tie its components together.
    """
    threshold = percent / 100
    labelled = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    rows = labelled.join(open_buckets(labelled), ["band", "key"]).join(reps, "rep").join(texts.withColumnRenamed("id", "rep"), "rep")
    rows = in_blocks(rows).select("band", "key", "bi", "bj", "own", "rep", "component", "n", "regs", "z")
    keys = ["band", "key", "bi", "bj"]

    def compare(t: pa.Table) -> list[tuple[int, int]]:
        rep, comp, n = (t[c].to_numpy() for c in ("rep", "component", "n"))
        if len(rep) < 2 or (comp == comp[0]).all():
            return []
        bi, bj, own = t["bi"][0].as_py(), t["bj"][0].as_py(), t["own"].to_numpy()
        band = t["band"][0].as_py()
        regs = _as_registers(t["regs"].combine_chunks())
        cols = regs.view(np.int64).reshape(len(rep), BANDS)
        right = np.flatnonzero(own == bj)
        pairs = []
        for i in np.flatnonzero(own == bi).tolist():
            js = right[right > i] if bi == bj else right
            js = js[(comp[js] != comp[i]) & (np.minimum(n[js], n[i]) >= threshold * np.maximum(n[js], n[i]) - 1e-9)]
            if band:
                js = js[~(cols[js, :band] == cols[i, :band]).any(axis=1)]
            js = js[(regs[js] == regs[i]).sum(axis=1) >= (threshold - MARGIN) * M - 8]  # far below: not worth an estimate
            pairs.append(np.stack([np.full(len(js), i), js]))
        x, y = np.concatenate(pairs, axis=1)
        if not len(x):
            return []
        likely_ = estimate(regs[x], regs[y], n[x].astype(float), n[y].astype(float)) >= threshold - MARGIN
        x, y = x[likely_].tolist(), y[likely_].tolist()
        z, up = t["z"], {}
        used = sorted({*x, *y})
        sets = dict(zip(used, shingle_sets([zlib.decompress(z[k].as_py()) for k in used]))) if used else {}

        def find(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        out = []
        for i, j in zip(x, y):
            ci, cj = find(int(comp[i])), find(int(comp[j]))
            if ci != cj and _linked(sets[i], sets[j], percent):
                up[ci] = cj
                out.append((rep[i], rep[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the bucket blocks that may still go on

        def done(t: pa.Table) -> list[tuple[int, int]]:
            cut = np.flatnonzero(np.any([t[k].to_numpy()[1:] != t[k].to_numpy()[:-1] for k in keys], axis=0)) + 1
            out = []
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), t.num_rows]):
                if b - a > 1:
                    out += compare(t.slice(a, b - a))
            return out

        def rows_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([int(x) for x, _ in out], pa.int64()), pa.array([int(y) for _, y in out], pa.int64())], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            t = pa.Table.from_batches(held)
            end = [t[k][-1].as_py() for k in keys]
            same = np.all([t[k].to_numpy() == e for k, e in zip(keys, end)], axis=0)
            first = int(np.argmax(same))
            if first:
                yield rows_of(done(t.slice(0, first)))
                held = t.slice(first).to_batches()
        if held:
            yield rows_of(done(pa.Table.from_batches(held)))

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that small but slow tasks are not put together
    return saved(rows.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Linked: 100 * common shingles >= ``percent`` * all shingles.  A text without
    words (null, empty) is linked with nothing.  Rows with the same id are one
    document.  A row without id is linked with nothing: its component is null, and it is kept.
    """
    threshold = percent / 100
    rows = keyed(docs, id_col, text_col).withColumn("node", F.xxhash64("doc_id", "text"))
    named = rows.filter("doc_id is not null")
    found = saved(sketches(rows), "sketches")
    nodes = found.filter("n > 0 and doc_id is not null")
    same = ["n", "h1", "h2"]
    classes = nodes.groupBy(*same).agg(F.min(F.struct("doc_id", "node")).alias("r"))
    classes = saved(classes.select(*same, F.col("r.doc_id").alias("rep_id"), F.col("r.node").alias("rep")), "classes")
    placed = nodes.join(classes, same)
    reps = saved(placed.filter("node = rep").select("rep", "n", "regs").dropDuplicates(["rep"]), "reps")

    bands = reps.select("rep", F.posexplode("regs").alias("band", "key"))
    buckets = saved(bands.groupBy("band", "key").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).filter("size > 1").select("band", "key", "pivot"), "buckets")
    members = saved(bands.join(buckets, ["band", "key"]), "members")
    texts = packed_texts(named, members)
    stars = members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = verified(likely(stars, reps, threshold), texts, percent)
    # Rows that repeat an id with another text tie their classes together.
    again = placed.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi").select("doc_id", "lo")
    links = links.union(placed.join(again, "doc_id").select("lo", "rep"))
    labels = components(links)
    rest = _across(members, reps, texts, labels, percent)
    labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)).withColumnRenamed("node", "rep")

    placed = classes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = placed.groupBy("component").agg(F.min("rep_id").alias("least"))
    group = placed.join(least, "component").select(*same, "least")
    out = found.select("doc_id", *same).join(group, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
