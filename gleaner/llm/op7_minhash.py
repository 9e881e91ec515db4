"""MinHash near-dedup by an LSH forest.

Every document gets ``TREES`` independent MinHash orders of ``DEPTH`` values each. Each order is
sorted, and a document's neighbours in it are those of the longest common prefix: where few
share its values that is a short one, where many do the order itself goes deeper, so the depth
adapts to every region. Of its neighbours in all orders with ``BASE`` values in common, a document's
first candidates are those of the longest prefixes, and the most central document of each
region, the documents that agree on ``BASE`` values of an order or on more where it is crowded.
What these leave open is completed by region: all pairs of a small one that aren't joined yet, and
in crowded ones an exact join on the rarest shingles. A map of parities bounds from below in how many
shingles two documents differ; candidates that it doesn't rule out are confirmed on full
shingle sets, which are made for these documents only.

Copies with equal shingle sets collapse to one representative before any candidate is
made, and pairs inside a component that is already known are not verified again, so a
group of thousands of copies costs a multiple of its size and never its square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import batches, dealt_join, matching, spread_join, table
from gleaner.llm.components import connected_components
from gleaner.llm.textvec import Batch, chunks, mix

TREES, DEPTH, BASE = 16, 8, 5
#: Neighbours that a document takes of all orders. A region of more rows than CROWD goes deeper, and gets its other pairs from
#: rare shingles.
NEIGHBOURS, CROWD = 2, 64
#: Most classes of equal sets that are broadcast, of three 64-bit keys each.
FEW_CLASSES = 100_000
#: Bits of a document's parity map, and counters of the sketch of shingle frequencies.
BITS, COUNTERS = 2048, 1 << 20
SIGNATURE_SCHEMA = "doc_id long, n_shingles long, h1 long, h2 long, keys array<long>, tails array<long>, bits array<long>"
SETS_SCHEMA = "id long, shingles array<long>"

_random = np.random.RandomState(20240607)
_A = _random.randint(1, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _random.randint(0, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``words``-word shingles.

    A-Z is lower-cased; words are runs free of ASCII white space. A text of fewer words is
    one shingle as a whole; a text without words has none.
    """
    batch = Batch(texts)
    start, end, text = batch.words()
    hashed = batch.hashes(start, end, lower=True)
    counts = np.bincount(text, minlength=batch.n)
    at = np.concatenate([[0], np.cumsum(counts)])
    grams = np.zeros(len(hashed), np.uint64)
    for k in range(words):
        grams[: len(hashed) - k] += hashed[k:] * np.uint64(2 * k + 3) + np.uint64(k)
        if k + 1 < words:
            grams = mix(grams)
    grams = mix(grams)
    out = []
    for i in range(batch.n):
        n = int(counts[i])
        if n >= words:
            out.append(np.unique(grams[at[i] : at[i + 1] - words + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for h in hashed[at[i] : at[i + 1]]:
                whole = mix(whole * np.uint64(31) + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEPTH MinHash values; long sets go through in slices to bound memory."""
    low = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    best = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 4096):
        best = np.minimum(best, (_A[:, None] * low[None, i : i + 4096] + _B[:, None]).min(axis=1))
    return best


def region_keys(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per tree a 64-bit key of the first BASE values and the next three packed in sorted order."""
    values = signatures.reshape(-1, TREES, DEPTH).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), values.shape[:2])
    for k in range(BASE):
        keys = mix(keys * np.uint64(0x100000001B3) + values[:, :, k])
    tails = np.zeros(values.shape[:2], np.uint64)
    for k in range(BASE, DEPTH):
        tails = (tails << np.uint64(21)) | (values[:, :, k] >> np.uint64(11))
    return keys.view(np.int64), tails.view(np.int64)


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """BITS bits, each the parity of how many shingles fall on it.

    Two sets whose maps differ in h bits differ in at least h shingles, whatever their sizes.
    """
    odd = (np.bincount((shingles >> np.uint64(53)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _signatures(words: int):
    def run(frames):
        for frame in frames:
            texts = frame.column("text").to_pylist()
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], words)
                signatures = np.stack([signature(s) for s in sets])
                keys, tails = region_keys(signatures)
                with np.errstate(over="ignore"):
                    h1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    h2 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                every = np.arange(0, TREES * (b - a) + 1, TREES, dtype=np.int32)
                bits = np.stack([parity_map(s) for s in sets])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": frame.column("doc_id").slice(a, b - a), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "h1": h1, "h2": h2, "keys": pa.ListArray.from_arrays(every, keys.ravel()),
                    "tails": pa.ListArray.from_arrays(every, tails.ravel()),
                    "bits": pa.ListArray.from_arrays(np.arange(0, bits.size + 1, bits.shape[1], dtype=np.int32), bits.ravel()),
                })
    return run


def _sets(words: int):
    def run(frames):
        for frame in frames:
            texts = frame.column("text").to_pylist()
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], words)
                at = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "id": frame.column("doc_id").slice(a, b - a),
                    "shingles": pa.ListArray.from_arrays(at, np.concatenate(sets).view(np.int64)),
                })
    return run


def _bounded(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can be linked by their parity maps, ``bits(id, n, bits)``. Loses no link."""
    left = bits.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = bits.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    both = dealt_join(dealt_join(pairs, left, "a", F.col("b")), right, "b", F.col("a"))
    apart = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    size = F.col("na") + F.col("nb")
    return both.where((100 + percent) * F.floor((size - apart) / 2) >= percent * size).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = dealt_join(dealt_join(pairs, left, "a", F.col("b")), right, "b", F.col("a"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b").distinct()


def _ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct unordered pairs whose sizes alone don't rule a link out."""
    return (
        pairs.where(F.col("x") != F.col("y"))
        .where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )


def _frequencies(frames):
    """Counters of the shingles of a task's sets, hashed to COUNTERS cells."""
    total = np.zeros(COUNTERS, np.int64)
    for frame in frames:
        flat = frame.column("shingles").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        total += np.bincount((flat >> np.uint64(33)).astype(np.int64) & (COUNTERS - 1), minlength=COUNTERS)
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int64()), "n": pa.array(total[cell], pa.int64())})


def _neighbours(frames):
    """Adjacent rows of a sorted order that share a region, from either end, with how many further values they share."""
    held = None
    for frame in frames:
        rows = np.stack([frame.column(c).to_numpy() for c in ("key", "tail", "id", "n")])
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        held = rows[:, -1:]
        same = np.flatnonzero(rows[0, 1:] == rows[0, :-1])
        apart = rows[1, same] ^ rows[1, same + 1]
        depth = ((apart >> 42) == 0).astype(np.int64) + ((apart >> 21) == 0) + (apart == 0)
        (x, nx), (y, ny) = rows[2:, same], rows[2:, same + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(v)) for v in ((x, y), (nx, ny), (y, x), (ny, nx), (depth, depth))], ["x", "nx", "y", "ny", "depth"])


def _prefixes(often: np.ndarray, percent: int):
    """Of each set the rarest shingles that a linked set must share one of, and how many are left from each."""
    def run(frames):
        for frame in frames:
            ids = frame.column("id").to_pylist()
            column = frame.column("shingles")
            flat, at = column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(column.value_lengths().to_numpy()))
            out_id, out_n, out_s, out_rest = [], [], [], []
            for i, own in enumerate(ids):
                s = flat[at[i] : at[i + 1]]
                n = len(s)
                take = n - -(-n * percent // 100) + 1
                df = often[(s.view(np.uint64) >> np.uint64(33)).astype(np.int64) & (COUNTERS - 1)]
                first = s[np.lexsort((s, df))[:take]]
                out_id.append(np.full(take, own))
                out_n.append(np.full(take, n))
                out_s.append(first)
                out_rest.append(n - np.arange(take))
            if ids:
                yield pa.RecordBatch.from_pydict({
                    k: pa.array(np.concatenate(v), pa.int64()) for k, v in (("id", out_id), ("n", out_n), ("s", out_s), ("rest", out_rest))})
    return run


def _rare_pairs(sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """All pairs (x, nx, y, ny) of ``sets(id, shingles)`` of different ``parts(id, part)`` that can be linked.

    Any one order of shingles will do: a set of n that is linked with another shares one of
    its first ``n - ceil(n * percent / 100) + 1`` with it, and the first shared place in both
    bounds what they have in common. Rarest first by a sketch of fixed size, so sets that share
    only what all share hardly meet; rows of the part that most of a shingle's rows are in
    meet only those of other parts.
    """
    counted = batches(sets, _frequencies, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 2").toArrow()
    often = np.zeros(COUNTERS, np.int64)  # at most COUNTERS rows come to the driver
    often[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    places = batches(sets, _prefixes(often, percent), "id long, n long, s long, rest long").join(parts, "id")
    places = table(places)
    lists = (
        places.groupBy("s", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("s")
        .agg(F.max(F.struct("k", "part")).alias("most"), F.sum("k").alias("rows"), F.count(F.lit(1)).alias("n_parts"))
        .where("n_parts > 1").select("s", F.col("most.part").alias("main"), F.ceil(F.col("rows") / (4 * CROWD)).alias("deals"))
    )
    placed = spread_join(places, lists, ["s"], F.col("id")).withColumn("other", (F.col("part") != F.col("main")).cast("int"))
    # The smaller set of a linked pair has its first shared shingle within a shorter prefix.
    left = placed.where((100 + percent) * F.col("rest") >= 2 * percent * F.col("n")).select(
        "s", F.pmod(F.xxhash64("id"), "deals").alias("deal"), F.explode(F.when(F.col("other") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("other"),
        F.col("id").alias("x"), F.col("n").alias("nx"), F.col("part").alias("px"), F.col("rest").alias("rx"))
    right = placed.select("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"), "other",
                          F.col("id").alias("y"), F.col("n").alias("ny"), F.col("part").alias("py"), F.col("rest").alias("ry"))
    meets = (left["px"] != right["py"]) & (left["nx"] <= right["ny"]) & (
        (100 + percent) * F.least(left["rx"], right["ry"]) >= percent * (left["nx"] + right["ny"]))
    on = (left["s"] == right["s"]) & (left["deal"] == right["deal"]) & (left["other"] == right["other"])
    return left.join(right, on & meets).select("x", "nx", "y", "ny")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links of Jaccard similarity of at
    least ``percent`` per cent; ``kept`` marks it. Null or blank texts have no shingles and
    link with nothing. Rows that share a doc_id are one document, judged by all their texts'
    links. Rows without a doc_id link with nothing, get a null component and are kept. An
    empty table gives an empty result; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = table(batches(slim, _signatures(words), SIGNATURE_SCHEMA))

    # Equal sets, by size and two sums of hashes: one representative each.
    known = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    same = ["n_shingles", "h1", "h2"]
    classes = known.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    classed = matching(signed, classes, same, "left", FEW_CLASSES).withColumn("rep", F.coalesce("rep", "doc_id"))
    reps = classed.where((F.col("doc_id") == F.col("rep")) & (F.col("n_shingles") > 0)).withColumnsRenamed({"doc_id": "id", "n_shingles": "n"})

    # The forest: a row per representative, tree and region of two or more.
    placed = reps.select("id", "n", F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("tails").alias("tail"))).alias("t")).select(
        "id", "n", F.col("t.key").alias("key"), F.col("t.tail").alias("tail"))
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    crowd = F.lit(CROWD)
    region = (
        F.when(F.col("size") <= crowd, F.col("key"))
        .when(F.col("size") <= crowd * 8, F.xxhash64("key", F.shiftrightunsigned("tail", 42)))
        .when(F.col("size") <= crowd * 64, F.xxhash64("key", F.shiftrightunsigned("tail", 21)))
        .otherwise(F.xxhash64("key", "tail"))
    )
    forest = table(spread_join(placed, sizes, ["key"], F.col("id")).withColumn("region", region))
    # Every order sorted as a whole: ranges of it are dealt over the tasks, so no region is one task. Neighbours that
    # a cut between ranges parts are left to the regions below, as all that are further apart.
    in_order = forest.repartitionByRange("key", "tail", "id").sortWithinPartitions("key", "tail", "id").select("key", "tail", "id", "n")
    adjacent = batches(in_order, _neighbours, "x long, nx long, y long, ny long, depth long")
    nearest = F.slice(F.array_sort(F.collect_set(F.struct((-F.col("depth")).alias("d"), "y", "ny"))), 1, NEIGHBOURS)  # of two an order at most
    neighbours = adjacent.where("x <> y").groupBy("x", "nx").agg(nearest.alias("near")).select("x", "nx", F.explode("near").alias("o")).select("x", "nx", "o.y", "o.ny")
    weighted = forest.join(forest.groupBy("id").agg(F.sum("size").alias("weight")), "id")

    def leaders(level: str) -> DataFrame:
        best = weighted.groupBy(level).agg(F.min(F.struct(-F.col("weight"), "id", "n")).alias("lead"))
        return spread_join(
            weighted.select(level, F.col("id").alias("x"), F.col("n").alias("nx")),
            best.select(level, F.col("lead.id").alias("y"), F.col("lead.n").alias("ny")), [level], F.col("x"),
        ).select("x", "nx", "y", "ny")

    bits = table(matching(reps.select("id", "n", "bits"), forest.select("id").distinct(), ["id"]))

    def sets_of(ids: DataFrame) -> DataFrame:
        return table(batches(matching(slim, ids.select(F.col("id").alias("doc_id")).distinct(), ["doc_id"]), _sets(words), SETS_SCHEMA))

    def linked(pairs: DataFrame) -> DataFrame:
        """Candidates, by their sizes and parity maps, then by full sets of those that are left."""
        left = table(_bounded(table(_ordered(pairs, percent)), bits, percent))
        return table(_verified(left, sets_of(left.select(F.explode(F.array("a", "b")).alias("id"))), percent))

    first = linked(neighbours.unionByName(leaders("key")).unionByName(leaders("region")))
    parts = connected_components(first).withColumnRenamed("component", "part")

    # All other pairs that share a key, where the first links don't already join them.
    members = table(forest.select("key", "id", "n", "size").join(parts, "id", "left").withColumn("part", F.coalesce("part", "id")))
    small = (
        members.where(F.col("size") <= CROWD).groupBy("key")
        .agg(F.collect_set(F.struct("part", "id", "n")).alias("all")).select("all", F.explode("all").alias("o"))
        .select(F.col("o.id").alias("x"), F.col("o.n").alias("nx"), F.explode(F.filter("all", lambda p: p["part"] > F.col("o.part"))).alias("p"))
        .select("x", "nx", F.col("p.id").alias("y"), F.col("p.n").alias("ny"))
    )
    crowded = members.where(F.col("size") > CROWD)
    mixed = crowded.groupBy("key").agg(F.min("part").alias("one"), F.max("part").alias("two")).where("one < two").select("key")
    crowded = table(spread_join(crowded.select("key", "id", "part"), mixed, ["key"], F.col("id")).select("id", "part").distinct())
    near = small.unionByName(_rare_pairs(sets_of(crowded), crowded, percent))
    joined = connected_components(first.unionByName(linked(near))).withColumnRenamed("id", "rep")

    mapped = spread_join(classed.select("doc_id", "n_shingles", "rep"), joined, ["rep"], F.col("doc_id"), how="left")
    component = F.coalesce("component", "rep")
    return mapped.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def recall(docs: DataFrame, found: DataFrame, words: int, percent: int, sample: int = 64) -> tuple[int, int]:
    """(links found, links there are) of ``sample`` documents, by comparing them with the full sets of all.

    ``found`` is a result of ``near_duplicates``. The sample is taken by a hash of the id, among documents that
    have a link according to it first, so that there is something to lose. Each task gets the sample's sets.
    """
    slim = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    groups = found.where("doc_id is not null").groupBy("component_id").agg(F.count(F.lit(1)).alias("size"))
    chosen = found.where("n_shingles > 0 and doc_id is not null").join(groups, "component_id").orderBy(F.col("size") == 1, F.xxhash64("doc_id"), "doc_id").limit(sample)
    asked = table(batches(matching(slim, chosen.select("doc_id").distinct(), ["doc_id"]), _sets(words), SETS_SCHEMA))
    sets = [(r.id, np.array(r.shingles, np.int64)) for r in asked.collect()]  # ``sample`` documents
    shared = docs.sparkSession.sparkContext.broadcast(sets)

    def compare(frames):
        for frame in frames:
            ids, column = frame.column("id").to_pylist(), frame.column("shingles")
            a, b = [], []
            for own, other in zip(ids, column):
                other = other.values.to_numpy(zero_copy_only=False)
                for mine, s in shared.value:
                    if mine != own and min(len(s), len(other)) * 100 >= percent * max(len(s), len(other)):
                        both = len(np.intersect1d(s, other, assume_unique=True))
                        if both and 100 * both >= percent * (len(s) + len(other) - both):
                            a.append(mine)
                            b.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    links = batches(batches(slim, _sets(words), SETS_SCHEMA), compare, "a long, b long").distinct()
    component = found.select("doc_id", "component_id").distinct()
    both = links.join(component.withColumnsRenamed({"doc_id": "a", "component_id": "ca"}), "a").join(component.withColumnsRenamed({"doc_id": "b", "component_id": "cb"}), "b")
    out = both.agg(F.count_if(F.col("ca") == F.col("cb")).alias("found"), F.count(F.lit(1)).alias("all")).first()
    return out.found, out.all


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles at Jaccard 0.85 over the whole of ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five words, similarity 0.8).

    Of rows that share a doc_id one stays, the least by a hash of its text. Rows without an id stay.
    """
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    kept = matching(docs, gone, ["doc_id"], "left_anti").select(*docs.columns)
    again = table(kept.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id"))
    if again.isEmpty():
        return kept
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    one = matching(kept, again, ["doc_id"]).select(*docs.columns, F.row_number().over(order).alias("_nth")).where("_nth = 1").drop("_nth")
    return matching(kept, again, ["doc_id"], "left_anti").select(*docs.columns).unionByName(one)
