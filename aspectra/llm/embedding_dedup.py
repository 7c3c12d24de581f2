"""Near-duplicate embeddings by sorted projection passes.

1. Equal vectors of a label become one class with a count.
2. The classes of a label and length are a group. In each pass every class of a group gets the
   signs of random projections of its difference from the group's mean, concatenated to one
   key of ``KEY_BITS`` bits. Each pass is range-sorted by group and key, dealt into blocks of
   neighbours that overlap by a window, and a class is compared with the ``window`` classes
   before it, across block borders too. A group has as many passes as a pair at the threshold
   needs to come within a window but for ``MISS``; they grow with the group.
3. A window cannot hold a run of more than ``RUN`` windows of classes with equal leading bits
   (the bits that should part the group into half windows). Such a run is also compared whole,
   block against block. A group so close about its mean that its passes would be more work than
   that has no leading bits: it is one such run. This keeps the result whole; its cost is the
   square of the run.
4. Verified pairs are united within a task and then over all passes. Inside each united group
   all direct links are counted exactly, block against block (``link_counts``, the square of the
   group), so a dense group larger than any window loses none; only sums leave a task.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aspectra.llm.batches import column, groups
from aspectra.llm.components import connected_components, local_forest
from aspectra.llm.vectors import matrix, unit, usable
from aspectra.plans.materialize import materialize

#: Least passes over a group larger than a window, and the classes before it that a class is compared with.
PASSES = 4
WINDOW = 128
KEY_BITS = 62
#: Windows of classes in a run of equal leading bits above which it is compared whole.
RUN = 8
#: Expected share of pairs at the threshold that no pass brings together; passes that are always worth their work.
MISS = 1e-4
FREE_PASSES = 64
#: Classes of a block of neighbours, of a block when a run is compared, and when links are counted.
NEAR_BLOCK = 4096
PAIR_BLOCK = 16_384
BLOCK = 4096


def _close(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """cosine >= threshold between unit rows; sums within rounding of it are taken again row by row."""
    dots = a @ b.T
    hit = dots >= threshold - 1e-12
    if hit.any():
        for i, j in np.argwhere(hit & (dots < threshold + 1e-12)):
            hit[i, j] = (a[i] * b[j]).sum() >= threshold
    return hit


def _linked(a: np.ndarray, b: np.ndarray, a32: np.ndarray, b32: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the pairs of ``_close``: single precision leaves few, which are taken again in double."""
    near = a32 @ b32.T >= np.float32(threshold - 1e-6 - 2e-7 * a.shape[1])
    n = np.count_nonzero(near)
    if n > near.size // 64:
        return np.nonzero(_close(a, b, threshold))
    i, j = np.nonzero(near) if n else (np.zeros(0, np.int64),) * 2
    hit = (a[i] * b[j]).sum(axis=1) >= threshold
    return i[hit], j[hit]


def _runs(col: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of equal vector length."""
    size = col.value_lengths().to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.flatnonzero(size[1:] != size[:-1]) + 1, [len(size)]]) if len(size) else np.zeros(1, np.int64)
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())


def plan(n: Column, spread: Column, threshold: float, passes: int, window: int) -> tuple[Column, Column]:
    """(leading bits, passes) for a group of ``n`` classes; no leading bits make it one run.

    ``spread``: mean squared distance of its unit vectors from their mean. A fifth is taken off,
    as vectors nearer to the mean than most are parted more often.
    """
    bits = F.least(F.ceil(F.log2(F.lit(2.0) * n / window)), F.lit(KEY_BITS)).cast("int")
    angle = F.acos(F.greatest(F.lit(-1.0), 1 - (1 - threshold) / F.greatest(0.8 * spread, F.lit(1e-12))))
    meet = F.pow(1 - angle / math.pi, bits)
    need = F.when(meet <= 1e-9, F.lit(2e9)).when(meet >= 1 - MISS, F.lit(1.0)).otherwise(F.ceil(math.log(MISS) / F.log(1 - meet)))
    need = F.greatest(need, F.lit(float(passes)))
    hopeless = (need > FREE_PASSES) & (need * window > n / 2)
    small = n <= window + 1  # a window holds the group
    return F.when(small | hopeless, 0).otherwise(bits), F.when(small | hopeless, 1).otherwise(need.cast("int"))


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of unit vectors of the task's rows, by label and length."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for a, b in _runs(column(batch, "vector")):
            part = batch.slice(a, b - a)
            x, label = unit(matrix(column(part, "vector"))), column(part, "label").to_numpy()
            for k in np.unique(label).tolist():
                mine = x[label == k].sum(axis=0)
                sums[k, x.shape[1]] = sums[k, x.shape[1]] + mine if (k, x.shape[1]) in sums else mine
    for (label, dim), total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim, label)), pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], ["label", "dim", "at", "total"],
        )


def _key_task(seed: int):
    """A row per class and pass: its leading bits and its whole key. Rows of a group stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _runs(column(batch, "vector")):
                part = batch.slice(a, b - a)
                label = column(part, "label").to_numpy()
                cuts = np.concatenate([[0], np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]])
                for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    mine = part.slice(i, j - i)
                    bits, passes = column(mine, "bits")[0].as_py(), column(mine, "passes")[0].as_py()
                    x = unit(matrix(column(mine, "vector")))
                    x = x - matrix(column(mine, "mean").slice(0, 1))
                    rows, dim = x.shape
                    for p in range(passes):
                        planes = np.random.default_rng([seed, p, dim]).standard_normal((dim, KEY_BITS))
                        key = ((x @ planes) > 0) @ (1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [column(mine, "label"), pa.array(np.full(rows, dim, np.int32)), pa.array(np.full(rows, p, np.int32)),
                             pa.array(key >> (KEY_BITS - bits)), pa.array(key), column(mine, "cid")],
                            ["label", "dim", "pass", "lead", "key", "cid"],
                        )

    return run


def _window_task(threshold: float, window: int):
    """Linked pairs at most ``window`` places apart in a block of neighbours, as forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in groups(batches, ("block", "label", "dim", "pass")):
            cid, place = table.column("cid").to_numpy(), table.column("place").to_numpy()
            vectors = table.column("vector").combine_chunks()
            us, vs = [], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                x, c, at = unit(matrix(vectors.slice(a, b - a))), cid[a:b], place[a:b]
                x32 = x.astype(np.float32)
                for lo in range(0, b - a, 256):
                    hi, low = min(lo + 256, b - a), max(0, lo - window)
                    i, j = _linked(x[lo:hi], x[low:hi], x32[lo:hi], x32[low:hi], threshold)
                    i, j = i + lo, j + low
                    ok = (at[i] > at[j]) & (at[i] - at[j] <= window)
                    u, v = local_forest(c[i[ok]], c[j[ok]])
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return run


def _pair_task(threshold: float):
    """Linked pairs of a run's block ``qb`` with its block ``tb``, as forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in groups(batches, ("label", "dim", "pass", "lead", "qb", "tb")):
            cid, block = table.column("cid").to_numpy(), table.column("b").to_numpy()
            qb, tb = table.column("qb").to_numpy(), table.column("tb").to_numpy()
            vectors = table.column("vector").combine_chunks()
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                x, c = unit(matrix(vectors.slice(a, b - a))), cid[a:b]
                same, asks = qb[a] == tb[a], np.flatnonzero(block[a:b] == qb[a])
                asked = asks if same else np.flatnonzero(block[a:b] == tb[a])
                y, d = x[asked], c[asked]
                y32, us, vs = y.astype(np.float32), [], []
                for at in range(0, len(asks), 256):
                    q, low = asks[at : at + 256], at if same else 0
                    i, j = _linked(x[q], y[low:], x[q].astype(np.float32), y32[low:], threshold)
                    i, j = c[q][i], d[low:][j]
                    u, v = local_forest(i[i != j], j[i != j])
                    us.append(u)
                    vs.append(v)
                if us:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return run


def group_plans(narrow: DataFrame, threshold: float, passes: int, window: int) -> DataFrame:
    """(label, dim, mean, bits, passes) for every group of ``narrow`` (label, dim, cid, vector)."""
    sums = narrow.sortWithinPartitions("dim", "label").select("label", "vector").mapInArrow(_sum_task, "label long, dim int, at int, total double")
    sums = sums.groupBy("label", "dim", "at").agg(F.sum("total").alias("total"))
    sums = sums.groupBy("label", "dim").agg(F.array_sort(F.collect_list(F.struct("at", "total"))).alias("totals"))
    sizes = narrow.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    facts = sizes.join(sums, ["label", "dim"]).withColumn("mean", F.transform("totals", lambda t: t["total"] / F.col("n")))
    spread = 1 - F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x)
    bits, need = plan(F.col("n"), spread, threshold, passes, window)
    return facts.select("label", "dim", "mean", bits.alias("bits"), need.alias("passes"))


def in_windows(keyed: DataFrame, classes: DataFrame, threshold: float, window: int, block: int = NEAR_BLOCK) -> DataFrame:
    """(u, v): linked classes at most ``window`` places apart in a pass's order of keys."""
    order = ["label", "dim", "pass", "key", "cid"]
    placed = keyed.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("part", F.shiftright("id", 33)), "projection-order")
    # a row per sorted partition: the window over them is one small task
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = placed.join(starts, "part").select("label", "dim", "pass", "cid", place.alias("place"))
    block = max(block, window)
    own = F.floor(F.col("place") / block)
    last = F.floor((F.col("place") + window) / block)
    dealt = dealt.withColumn("block", F.explode(F.sequence(own, last)))
    rows = dealt.join(classes.select("cid", "vector"), "cid")
    at = ["block", "label", "dim", "pass"]
    return rows.repartition("block").sortWithinPartitions(*at, "place").mapInArrow(_window_task(threshold, window), "u long, v long")


def in_runs(keyed: DataFrame, classes: DataFrame, threshold: float, window: int) -> DataFrame:
    """(u, v): linked classes of the runs of equal leading bits that are too long for a window."""
    run = ["label", "dim", "pass", "lead"]
    size = keyed.groupBy(*run).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("cid").alias("x"), F.bit_xor(F.xxhash64("cid")).alias("y"))
    # a run that passes repeat, as a narrow cluster does, is compared once
    size = size.where(F.col("n") > RUN * window).groupBy("label", "dim", "n", "x", "y").agg(F.min(F.struct("pass", "lead")).alias("r"))
    size = size.select("label", "dim", "r.pass", "r.lead", F.ceil(F.col("n") / PAIR_BLOCK).cast("int").alias("nb"))
    dealt = keyed.join(size, run).join(classes.select("cid", "vector"), "cid").withColumn("b", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    pairs = pairs.select(*run, F.least("b", "other").alias("qb"), F.greatest("b", "other").alias("tb"), "b", "cid", "vector")
    at = [*run, "qb", "tb"]
    return pairs.repartition(*at).sortWithinPartitions(*at, "cid").mapInArrow(_pair_task(threshold), "u long, v long")


def projection_links(classes: DataFrame, threshold: float, passes: int = PASSES, window: int = WINDOW, seed: int = 17, runs: bool = True) -> DataFrame:
    """(u, v): links found between classes (label, cid, vector), as forests that join the linked ones.

    ``passes`` is the least number of passes over a group that a window does not hold. Without
    ``runs`` the windows are alone, which measures what the sorted passes find by themselves.
    """
    narrow = classes.withColumn("dim", F.size("vector"))
    plans = materialize(group_plans(narrow, threshold, passes, window), "projection-plans")
    keyed = narrow.join(plans, ["label", "dim"]).sortWithinPartitions("dim", "label")
    keyed = keyed.mapInArrow(_key_task(seed), "label long, dim int, pass int, lead long, key long, cid long")
    keyed = materialize(keyed, "projection-keys")
    near = in_windows(keyed, classes, threshold, window)
    return near.unionByName(in_runs(keyed, classes, threshold, window)) if runs else near


def _count_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in groups(batches, ("root", "qb", "tb")):
            asks, cid, copies = (table.column(c).to_numpy() for c in ("asks", "cid", "copies"))
            vectors = table.column("vector").combine_chunks()
            ids, links = [], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                x, q, c = unit(matrix(vectors.slice(a, b - a))), asks[a:b], cid[a:b]
                hit = _close(x[q], x[~q], threshold) & (c[q][:, None] != c[~q][None, :])
                ids.append(c[q])
                links.append(hit @ copies[a:b][~q])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(links).astype(np.int64))], ["cid", "links"])

    return run


def link_counts(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(cid, links): copies of other classes of the same root within the threshold of a class.

    ``members``: root, cid, copies, vector. A large group is dealt into blocks, a task per pair.
    """
    size = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("nb"))
    dealt = members.join(size, "root").withColumn("b", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    asking = dealt.select("root", F.col("b").alias("qb"), other.alias("tb"), F.lit(True).alias("asks"), "cid", "copies", "vector")
    asked = dealt.select("root", other.alias("qb"), F.col("b").alias("tb"), F.lit(False).alias("asks"), "cid", "copies", "vector")
    tasks = asking.unionByName(asked).repartition("root", "qb", "tb").sortWithinPartitions("root", "qb", "tb", "cid")
    return tasks.mapInArrow(_count_task(threshold), "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, passes: int = PASSES, window: int = WINDOW, seed: int = 17) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors`` (vec_id, embedding, label).

    Vectors of one label and one length link at a cosine of ``threshold`` or more; vectors that
    are null, empty, zero or hold null or non-finite components, and rows without a label, link
    with nothing and are their own component. Repeated rows are copies that link. component_id is
    the smallest vec_id reachable (nulls only where there is no other); kept is false for a null
    vec_id. Other columns are ignored; an empty table gives an empty result.
    """
    wide = F.col("embedding").cast("array<double>")
    ok = usable(F.col("embedding")) & F.col("label").isNotNull()
    rows = vectors.select("vec_id", F.when(ok, wide).alias("vector"), F.when(ok, F.col("label").cast("long")).alias("label"))
    rows = rows.withColumn("cid", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    classes = rows.where("cid IS NOT NULL").groupBy("label", "vector", "cid").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "projection-classes")
    links = projection_links(classes.select("label", "cid", "vector"), threshold, passes, window, seed)
    roots = materialize(connected_components(links, "projection-cc"), "projection-roots")
    members = classes.join(roots.withColumnRenamed("node", "cid"), "cid").select("root", "cid", "copies", "vector")
    counted = link_counts(members, threshold)
    named = classes.select("cid", "first", "copies").join(roots.withColumnRenamed("node", "cid"), "cid", "left").join(counted, "cid", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "cid")), "projection-links")
    heads = named.groupBy("root").agg(F.min("first").alias("component_id"))
    result = named.join(heads, "root").select("cid", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "cid").join(result, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
