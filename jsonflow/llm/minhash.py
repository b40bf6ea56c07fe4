"""Near-duplicate documents by fast similarity sketches.

A sketch has ``COORDS`` coordinates. Round i < COORDS hashes every shingle into a random bin with a
random value; round COORDS + j puts every shingle into bin j. A coordinate keeps what reached its
bin first (round, then value). Rounds end as soon as every bin is filled, after one or two rounds
for sets larger than the sketch, and the last rounds fill each bin for certain, so that no
coordinate is ever left empty and estimates are as concentrated as those of independent minima.

1. One pass over the texts makes sketches and band keys. Documents with equal shingle sets are one
   class from here on, numbered for the joins that follow; the text of its smallest id stands for it.
2. Each member of a band bucket is verified on full sets against the bucket's smallest id. This is
   linear in the bucket and joins what belongs together in all but border cases.
3. Where candidates of one cluster still lie in different components, what is outside the
   cluster's main component is compared with everything in it, in blocks of bounded size: by
   sketch first, then on full sets, leaving out what is joined meanwhile.

Members of a hot bucket are dealt out in parts, blocks are dealt by hash, and no bucket is cut. Joins with
whole texts are merge joins at every size.

A document without words, or null, has an empty set and is linked with nothing. Rows that repeat
an id are judged as documents of their own, by id and text; a row with a null id has component null and is kept.
Of equal sets the smallest id counts as the class's. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored, texts_of
from jsonflow.llm.components import components
from jsonflow.llm.hashing import U, as_bytes, mix, shingle_set

COORDS = 100
# Members of one salted part of a bucket, and documents of one block.
PART, BLOCK = 500, 1000


def sketch(elements: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes: (round << 32 | value) per bin."""
    out = np.zeros(coords, dtype=U)
    empty = np.ones(coords, dtype=bool)
    # Rounds are taken in growing groups; each group settles the bins that are still empty.
    first, step = 0, 1
    while first < coords:
        last = min(coords, first + step)
        rounds = np.arange(first, last, dtype=U)[:, None]
        h = mix(elements[None, :] + rounds * U(0x9E3779B97F4A7C15), 11).ravel()
        bins = ((h >> U(32)) * U(coords)) >> U(32)
        values = (np.repeat(rounds.ravel(), len(elements)) << U(32)) | (h & U(0xFFFFFFFF))
        order = np.lexsort((values, bins))
        bins, values = bins[order], values[order]
        head = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        at = bins[head].astype(np.int64)
        new = empty[at]
        out[at[new]] = values[head][new]
        empty[at[new]] = False
        if not empty.any():
            return out
        # About a thousand hashes a group: one round for large sets, many for small ones.
        first, step = last, max(1, 1024 // len(elements))
    for b in np.flatnonzero(empty):
        h = mix(elements + U((coords + int(b)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), 11)
        out[b] = (U(coords + int(b)) << U(32)) | (h & U(0xFFFFFFFF)).min()
    return out


def band_rows(percent: int) -> int:
    """Rows of a band, so that a pair at the threshold is missed less than once in 100,000 times."""
    s = percent / 100
    return max(r for r in range(1, 11) if (1 - s**r) ** (COORDS // r) < 1e-5 or r == 1)


def _sketches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    import xxhash

    bands = COORDS // rows
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, text_hash in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
            s = shingle_set(text)
            if not len(s):
                out.append((doc_id, 0, text_hash, None, None, None))
                continue
            k = sketch(s)
            keys = np.zeros(bands, dtype=U)
            for r in range(rows):
                keys = mix(keys + k[r : bands * rows : rows], 20 + r)
            out.append((doc_id, len(s), text_hash, xxhash.xxh3_128_digest(s.tobytes()), mix(keys + np.arange(bands, dtype=U), 5).view(np.int64), (mix(k, 9) & U(0xFFFF)).astype(np.uint16).tobytes()))
        cols = list(zip(*out)) if out else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
        names = ["doc_id", "n_shingles", "text_hash", "digest", "bands", "sketch"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t).tobytes() for t in as_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "elements"])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def _star_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come by leader and part, the leader's own set first."""
    here, lead = None, None
    for batch in batches:
        a, b = [], []
        leaders, parts, reps, sets = (batch.column(i).to_pylist() for i in range(4))
        for leader, part, rep, raw in zip(leaders, parts, reps, sets):
            elements = np.frombuffer(raw, dtype=U)
            if rep == leader:
                here, lead = (leader, part), elements
            elif here == (leader, part) and _linked(lead, elements, percent):
                a.append(leader)
                b.append(rep)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _block_links(group: pa.Table, percent: int, main: bool) -> pa.Table:
    """Links that join different components among the rows of a block pair.

    Pairs are tried from the most similar sketches down; a pair that is joined already is left out.
    """
    reps, comps = group["rep"].to_pylist(), group["component"].to_pylist()
    sides = np.array(group["side"].to_pylist())
    sets = [np.frombuffer(x, dtype=U) for x in group["elements"].to_pylist()]
    sketches = np.stack([np.frombuffer(x, dtype=np.uint16) for x in group["sketch"].to_pylist()])
    names: dict = {}
    parent = [names.setdefault(c, i) for i, c in enumerate(comps)]
    label = np.array(parent)
    # Four and a half standard deviations below the threshold.
    s = percent / 100
    least = int(COORDS * (s - 4.5 * (s * (1 - s) / COORDS) ** 0.5))
    found = []
    for lo in range(0, len(reps), 128):
        same = (sketches[lo : lo + 128, None, :] == sketches[None, :, :]).sum(axis=2, dtype=np.int16) if len(reps) <= 256 else np.stack(
            [(sketches == row).sum(axis=1, dtype=np.int16) for row in sketches[lo : lo + 128]]
        )
        i, j = np.nonzero(same >= least)
        keep = (lo + i < j) & (label[lo + i] != label[j]) & ((sides[lo + i] != sides[j]) | (not main))
        found.append(np.stack((same[i, j][keep], lo + i[keep], j[keep])))
    pairs = np.concatenate(found, axis=1)
    links = []
    for _, i, j in pairs[:, np.argsort(-pairs[0], kind="stable")].T.tolist():
        x, y = _find(parent, i), _find(parent, j)
        if x != y and _linked(sets[i], sets[j], percent):
            parent[max(x, y)] = min(x, y)
            links.append((reps[i], reps[j]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _hard_links(star: DataFrame, links: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The remaining links, between components of one candidate cluster."""
    cluster = components(star.select(F.col("leader").alias("a"), F.col("rep").alias("b")))
    comp = components(links)
    at = cluster.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).join(
        comp.withColumnRenamed("node", "rep"), "rep", "left"
    )
    at = stored(at.select("rep", "cluster", F.coalesce("component", "rep").alias("component")))
    sizes = at.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("cluster").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n")
    )
    hard = sizes.where("parts > 1").select(
        "cluster",
        "main",
        F.ceil(F.col("n_main") / BLOCK).cast("int").alias("n_main"),
        F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("n_rest"),
    )
    at = at.join(hard, "cluster")
    is_main = F.col("component") == F.col("main")
    blocks = F.when(is_main, F.col("n_main")).otherwise(F.col("n_rest"))
    at = at.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("is_main", is_main)
    # Main blocks meet each block of the rest; blocks of the rest meet each other and themselves.
    rest = F.sequence(F.lit(0), F.col("n_rest") - 1)
    b = F.col("block")
    with_main = F.transform(F.sequence(F.lit(0), F.col("n_main") - 1), lambda j: F.struct(F.lit(True).alias("main"), j.alias("x"), b.alias("y"), F.lit(1).alias("side")))
    with_rest = F.transform(
        rest,
        lambda j: F.struct(F.lit(False).alias("main"), F.least(j, b).alias("x"), F.greatest(j, b).alias("y"), F.when(j <= b, 1).otherwise(0).alias("side")),
    )
    as_main = F.transform(rest, lambda j: F.struct(F.lit(True).alias("main"), b.alias("x"), j.alias("y"), F.lit(0).alias("side")))
    to = F.explode(F.when(F.col("is_main"), as_main).otherwise(F.concat(with_main, with_rest))).alias("to")
    dealt = at.select("rep", "cluster", "component", to).select("rep", "cluster", "component", "to.*")
    dealt = dealt.join(sets, "rep").join(sketches, "rep")

    def link(key, group):
        return _block_links(group, percent, key[1].as_py())

    return dealt.groupBy("cluster", "main", "x", "y").applyInArrow(link, "a long, b long")


def _hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _judged(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, digest, first``: one row per document; ``first`` is the text that
    stands for the component, among those of its smallest id."""
    texts = texts_of(docs, id_col, text_col).withColumn("text_hash", _hash(F.col("text")))
    rows = band_rows(percent)
    schema = "doc_id long, n_shingles long, text_hash long, digest binary, bands array<long>, sketch binary"
    made = stored(texts.mapInArrow(lambda b: _sketches(b, rows), schema))
    some = made.where("doc_id IS NOT NULL AND n_shingles > 0")
    # Equal sets have equal bands and sketches, so any will do.
    classes = some.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))

    keyed = classes.select("rep", F.explode("bands").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    star = stored(keyed.join(leaders, "key").where("rep <> leader").select("leader", "rep").distinct())
    if star.isEmpty():
        linked = None
    else:
        some_rep = star.select("rep").union(star.select("leader")).distinct()
        wanted = classes.join(some_rep, "rep").select("rep", "first.doc_id", "first.text_hash").hint("merge")
        wanted = texts.where("doc_id IS NOT NULL").join(wanted, ["doc_id", "text_hash"]).select("rep", "text")
        sets = stored(wanted.mapInArrow(_sets, "rep long, elements binary").dropDuplicates(["rep"]))
        sketches = classes.select("rep", "sketch")
        parts = star.groupBy("leader").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        members = star.join(parts, "leader").select("leader", F.pmod(F.xxhash64("rep"), "parts").cast("int").alias("part"), "rep")
        own = parts.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("rep"))
        dealt = members.union(own).join(sets, "rep").select("leader", "part", "rep", "elements")
        dealt = dealt.repartition("leader", "part").sortWithinPartitions("leader", "part", F.col("rep") != F.col("leader"), "rep")
        links = stored(dealt.mapInArrow(lambda b: _star_links(b, percent), "a long, b long"))
        more = _hard_links(star, links, sets, sketches, percent)
        linked = components(stored(links.union(more)))

    # Back to documents: class, then component. Hot classes are split by the adaptive skew join.
    classes = classes.select("digest", "rep", "first")
    if linked is not None:
        classes = classes.join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        classes = stored(classes.select("digest", "first", F.coalesce("component", "rep").alias("component")))
        least = classes.groupBy("component").agg(F.min("first").alias("first"))
        classes = classes.select("digest", "component").join(least, "component")
    classes = classes.select("digest", "first")
    told = some.join(classes, "digest").select("doc_id", "text_hash", "n_shingles", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("first"))
    alone = made.where("doc_id IS NULL OR n_shingles = 0")
    return told.union(alone.select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.col("text_hash").alias("first")))


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per document.

    Documents with 100 * |A and B| >= percent * |A or B| are linked; a component is what links
    connect, and the document whose id is the component's smallest is kept.
    """
    out = _judged(docs, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_copies(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: a text of the smallest id.

    Rows are told apart by id and text. Of rows that repeat both, one stays.
    """
    judged = stored(_judged(docs, percent, id_col, text_col).where("doc_id IS NOT NULL"))
    key = [F.col("doc_id").alias("_copy_id"), F.col("text_hash").alias("_copy_hash")]
    is_first = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("first"))
    copies = stored(judged.where(~is_first).select(*key).distinct())
    same = (docs[id_col].cast("long") == F.col("_copy_id")) & (_hash(docs[text_col]) == F.col("_copy_hash"))
    kept = docs.join(copies, same, "left_anti")
    again = judged.where(is_first & (F.col("n_shingles") > 0)).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    again = stored(again)
    if again.isEmpty():
        return kept
    # Rows that repeat id and text: one of each, whatever their other columns hold.
    once = kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, same, "left_anti").union(once)
