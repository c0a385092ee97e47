"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact verification.

Documents with equal shingle sets form a class; one per class goes on. Signature bands
collect candidates into buckets. Every member of a bucket is compared with the bucket's
smallest row id; once these links are joined into components, only members of different
components that still share a bucket are compared with each other, inside tasks, in
blocks, and each pair only in the first bucket it shares; a task reports links that join
what it has not joined yet, so it reports fewer links than members. A comparison looks at the signatures batch by batch and stops as soon as the
posterior probability that the similarity reaches the threshold falls below ``miss``
(uniform prior); what survives is verified on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import RID, WindowHash, discard, mix64, restore_ids, store, table, text_chunks, with_row_ids
from tidemark.llm.components import components
from tidemark.llm.op9_recompression import WordHashes, word_hashes

BANDS, ROWS, BATCH, HASHES = 24, 5, 16, 128
#: members of one hub, and members of one bucket, that a task compares at a time
HUB_BLOCK, BUCKET_BLOCK = 2000, 512


def shingle_set(text: bytes, size: int, cache: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    wh = WindowHash(word_hashes(words, cache))
    k = min(n, size)
    start = np.arange(n - k + 1)
    return np.unique(wh(start, start + k))


def signature(values: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    mul, add = seeds
    low = np.full(len(mul), 0xFFFFFFFF, dtype=np.uint32)
    v = (values >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(v), 1024):
        low = np.minimum(low, (v[k:k + 1024, None] * mul + add).min(axis=0))
    return low


def hash_seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (r[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (r[n:] >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, miss: float) -> list[int]:
    """After each batch, the fewest equal hashes at which P(similarity >= threshold) is still >= miss.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and
    its upper tail is the chance that Binomial(n + 1, threshold) is at most m.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


_SIG = pa.schema([(RID, pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()),
                  ("bands", pa.list_(pa.int64()))])
_SIG_DDL = f"{RID} long, n_shingles long, digest binary, sig binary, bands array<long>"


def _signatures(shingle: int):
    seeds = hash_seeds(HASHES)
    cache = WordHashes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, 2 << 20):
            rows = []
            for rid, text in zip(ids, texts, strict=True):
                values = shingle_set(text, shingle, cache)
                row = {RID: rid, "n_shingles": len(values)}
                if len(values):
                    sig = signature(values, seeds)
                    b = sig[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                    h = np.arange(1, BANDS + 1, dtype=np.uint64)
                    for r in range(ROWS):
                        h = mix64(h * np.uint64(0xA24BAED4963EE407) + b[:, r])
                    row |= {"digest": hashlib.blake2b(values.tobytes(), digest_size=16).digest(),
                            "sig": sig.tobytes(), "bands": h.view(np.int64)}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_SIG)
    return task


def _sets(shingle: int):
    cache = WordHashes()
    schema = pa.schema([("id", pa.int64()), ("body", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, 2 << 20):
            yield pa.RecordBatch.from_pylist(
                [{"id": i, "body": shingle_set(t, shingle, cache).tobytes()} for i, t in zip(ids, texts, strict=True)],
                schema=schema)
    return task


def _hub_task(compare):
    """Rows sorted by (hub, block, kind): the hub's body, then its members; yields the pairs that pass."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = body = None
        for batch in batches:
            rows = []
            hubs, kinds, ids, bodies = (batch.column(batch.schema.get_field_index(c)) for c in ("hub", "kind", "id", "body"))
            for i in range(batch.num_rows):
                if kinds[i].as_py() == 0:
                    hub, body = hubs[i].as_py(), bodies[i].as_py()
                elif compare(body, bodies[i].as_py()):
                    rows.append({"a": hub, "b": ids[i].as_py()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return task


def _compare_with_hub(pairs: DataFrame, bodies: DataFrame, compare, parts: int) -> DataFrame:
    """The pairs (a, b) whose bodies pass ``compare``; members of a large hub are split into blocks."""
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_BLOCK).cast("int").alias("blocks"))
    members = (pairs.join(blocks, "a")
               .select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"),
                       F.lit(1).alias("kind"), F.col("b").alias("id"))
               .join(bodies.hint("merge"), "id").select("hub", "block", "kind", "id", "body"))
    hubs = (blocks.select(F.col("a").alias("id"), "blocks").join(bodies.hint("merge"), "id")
            .select(F.col("id").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                    F.lit(0).alias("kind"), "id", "body"))
    return (members.unionByName(hubs).repartition(parts, "hub", "block").sortWithinPartitions("hub", "block", "kind")
            .mapInArrow(_hub_task(compare), "a long, b long"))


def _signature_compare(least: list[int]):
    def compare(x: bytes, y: bytes) -> bool:
        same = np.frombuffer(x, dtype="<u4") == np.frombuffer(y, dtype="<u4")
        m = 0
        for k, need in enumerate(least):
            m += int(np.count_nonzero(same[k * BATCH:(k + 1) * BATCH]))
            if m < need:
                return False
        return True
    return compare


def _exact_compare(numerator: int, denominator: int):
    def compare(x: bytes, y: bytes) -> bool:
        a, b = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
        # sorted distinct values: the common ones are neighbours once both are merged
        z = np.sort(np.concatenate([a, b]), kind="stable")
        inter = int(np.count_nonzero(z[1:] == z[:-1]))
        return denominator * inter >= numerator * (len(a) + len(b) - inter)
    return compare


def _bucket_task(least: list[int], exact):
    """Rows sorted by (bucket, i, j): links between members of different components."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(band, ids, side, comp, top, sigs, bodies):
        sig = np.frombuffer(b"".join(sigs), dtype="<u4").reshape(len(ids), HASHES)
        side, group, top = np.array(side), np.array(comp), np.array(top)
        root = {c: c for c in comp}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c
        out = []
        for k in np.flatnonzero(side != 1).tolist():
            # k is outside the largest component; of two such members the smaller component's meets the other
            c = np.flatnonzero((group != group[k]) & (side != 0) & (top | (group[k] < group)))
            m = np.zeros(len(c), dtype=np.int64)
            for n, need in enumerate(least):
                if len(c) == 0:
                    break
                cols = slice(n * BATCH, (n + 1) * BATCH)
                m += (sig[c, cols] == sig[k, cols]).sum(axis=1)
                c, m = c[m >= need], m[m >= need]
            if len(c) and band:  # a pair that shares an earlier band is compared there
                before = (sig[c, :band * ROWS] == sig[k, :band * ROWS]).reshape(len(c), band, ROWS).all(axis=2).any(axis=1)
                c = c[~before]
            for x in c.tolist():
                a, b = find(comp[k]), find(comp[x])
                if a != b and exact(bodies[k], bodies[x]):
                    root[max(a, b)] = min(a, b)
                    out.append({"a": ids[k], "b": ids[x]})
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            rows = []
            cols = [batch.column(batch.schema.get_field_index(c))
                    for c in ("bucket", "i", "j", "band", "id", "side", "comp", "top", "sig", "body")]
            for r in range(batch.num_rows):
                key = tuple(c[r].as_py() for c in cols[:4])
                if key != at:
                    if held:
                        rows += links(at[3], *held)
                    at, held = key, ([], [], [], [], [], [])
                for h, c in zip(held, cols[4:], strict=True):
                    h.append(c[r].as_py())
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist(links(at[3], *held), schema=schema)
    return task


def _dealt_members(buckets: DataFrame) -> DataFrame:
    """(bucket, band, i, j, id, side, comp, top): the members that have to meet, by pairs of blocks.

    Members outside the bucket's largest component (side 0) meet all its members (side 1); in
    a bucket of one block they stand on both sides (2). A member of the largest component is
    repeated once per block of the others, so a bucket that is nearly one component is
    hardly repeated at all.
    """
    size = buckets.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = (size.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("n"))
             .select("bucket", F.col("most.comp").alias("most"),
                     F.ceil((F.col("n") - F.col("most.n")) / BUCKET_BLOCK).cast("int").alias("xs"),
                     F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("ys")).filter("xs > 0"))
    rows = store(buckets.join(mixed, "bucket").withColumn("top", F.col("comp") == F.col("most"))
                 .select("bucket", "band", "id", "comp", "top", "xs", "ys"), "mixed_buckets")

    def own(n: str):
        return F.pmod(F.xxhash64("id", F.lit(n)), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    single = (F.col("xs") == 1) & (F.col("ys") == 1)
    y = rows.select("bucket", "band", every("xs").alias("i"), own("ys").alias("j"), "id",
                    F.when(single & ~F.col("top"), 2).otherwise(1).alias("side"), "comp", "top")
    x = rows.filter(~single & ~F.col("top")).select("bucket", "band", own("xs").alias("i"), every("ys").alias("j"), "id",
                                                    F.lit(0).alias("side"), "comp", "top")
    return x.unionByName(y)


def _across(buckets: DataFrame, bodies: DataFrame, least: list[int], exact, parts: int) -> DataFrame:
    """Links between members of different components that share a bucket."""
    return (_dealt_members(buckets).join(bodies.hint("merge"), "id")
            .select("bucket", "i", "j", "band", "id", "side", "comp", "top", "sig", "body")
            .repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(_bucket_task(least, exact), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = 1e-7) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the component of near duplicates it belongs to.

    Two documents are linked when ``100 * intersection >= percent * union`` of their sets
    of ``shingle``-word shingles (A-Z lower-cased; a shorter text is one shingle).
    Candidates are the documents that share one of 24 bands of 5 MinHash values; pruning
    drops a candidate when its posterior chance to reach the threshold is under ``miss``;
    links are confirmed on the full sets.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable, itself
    included), kept (doc_id = component_id). Null, empty and white-space texts have
    empty sets and stand alone. Rows with null or repeated ids count as documents of
    their own, ordered by (id, text) with nulls first; kept marks the first of each
    component and component_id is that row's id. Other columns are ignored.
    """
    rows, own = with_row_ids(docs)
    out = _components_of(rows, shingle, percent, miss)
    first = F.col(RID) == F.col("root")
    if own:
        kind = dict(rows.dtypes)["doc_id"]
        return out.select(F.col(RID).cast(kind).alias("doc_id"), "n_shingles",
                          F.col("root").cast(kind).alias("component_id"), first.alias("kept"))
    roots = rows.select(F.col(RID).alias("root"), F.col("doc_id").alias("component_id"))
    out = out.withColumn("kept", first).join(roots, "root").drop("root")
    return restore_ids(out, rows, own).select("doc_id", "n_shingles", "component_id", "kept")


def _components_of(rows: DataFrame, shingle: int, percent: int, miss: float) -> DataFrame:
    """(RID, n_shingles, root)"""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = least_matches(percent / 100, miss)
    sigs = store(rows.select(RID, "text").mapInArrow(_signatures(shingle), _SIG_DDL), "signatures")
    counts = store(sigs.select(RID, "n_shingles"), "counts")
    member = sigs.filter("n_shingles > 0").select(RID, "digest")
    # stored, so that the join below has an exchange of its own on either side and a hot digest can be split
    classes = store(member.groupBy("digest").agg(F.min(RID).alias("rep")), "digests")
    member = store(member.join(classes, "digest").select(RID, "rep"), "classes")
    # none of these sides has a proven bound, so none is broadcast, at any size
    first = member.filter(F.col("rep") == F.col(RID)).select(F.col(RID).alias("id"))
    reps = store(sigs.select(F.col(RID).alias("id"), "sig", "bands").join(first.hint("merge"), "id", "left_semi"),
                 "representatives")
    discard(spark, sigs, classes)
    bands = reps.select("id", F.posexplode("bands").alias("band", "bucket"))
    hubs = (bands.groupBy("bucket").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").drop("n"))
    buckets = store(bands.join(hubs.hint("merge"), "bucket"), "buckets")
    discard(spark)
    need = buckets.select(F.col("id").alias(RID)).distinct()
    sets = rows.select(RID, "text").join(need.hint("merge"), RID, "left_semi").mapInArrow(_sets(shingle), "id long, body binary")
    bodies = store(sets.join(reps.select("id", "sig").hint("merge"), "id"), "sets")
    discard(spark, reps)
    exact = _exact_compare(percent, 100)

    star = buckets.filter("a != id").select("a", F.col("id").alias("b")).distinct()
    star = _compare_with_hub(star, bodies.select("id", F.col("sig").alias("body")), _signature_compare(least), parts)
    star = store(star, "star_candidates")
    links = store(_compare_with_hub(star, bodies.select("id", "body"), exact, parts), "star_links")
    discard(spark, star)
    found = components(links)
    comp = (buckets.select("bucket", "band", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
            .select("bucket", "band", "id", F.coalesce("root", "id").alias("comp")))
    comp = store(comp, "bucket_components")
    discard(spark, buckets)
    more = store(_across(comp, bodies, least, exact, parts), "across_links")
    discard(spark, comp, bodies)
    if more.limit(1).count():
        found = components(links.unionByName(more))
    return (counts.join(member, RID, "left")
            .join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .select(RID, "n_shingles", F.coalesce("root", "rep", RID).alias("root")))


def op2_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: 3-word shingles, similarity 0.85 or more, whole texts of ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
