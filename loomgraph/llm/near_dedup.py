"""MinHash near-duplicate detection: one-permutation hashing with optimal densification, banded
buckets, star-shaped candidate edges, exact confirmation, connected components.

Every text is one set of word shingles, as 64-bit hashes. Texts with the same set collapse to one
node first (aggregation with partial sums, so a group of copies of any size costs one node). Bands of
the nodes' signatures make buckets. Within a bucket only star edges centre-member are proposed, so
their number is linear in the bucket. Edges are confirmed on full sets. As a star may miss a link
between two members that the centre lacks, buckets whose members lie in several components after the
first round are revisited: the members outside the centre's component meet the bucket's members of
other components in one block, if the bucket holds at most BLOCK members. The members of larger buckets
meet where they share one of their rarest shingles, of which each text takes so many that texts as similar
as asked must share one, and the shorter of the two must hold it among a still smaller number; work thus grows
with the sharing of rare shingles, not with the square of a bucket.
A pair leaves its block only if an exact bound on its overlap, from the shingles counted by hash cell,
doesn't rule the link out; then full sets decide. No cap drops a pair.

Defined results: null, empty or white-space text: n_shingles 0, linked with nothing. Rows that share
a doc_id are one document and are linked. A null doc_id is linked with nothing: component_id null,
kept true. An empty table gives an empty result. Extra columns are ignored by `near_duplicates`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import forget, fresh, letters_of, materialise, row_slices, small_side
from loomgraph.llm.shingles import mix, shingle_hashes, word_hashes

BANDS, ROWS = 32, 5
_SLICE = 1 << 20
#: Hash cells of a text's profile; members of a bucket that is one block, and rows of either side of a block.
CELLS, BLOCK = 256, 2048


def _probe_order(bins: int) -> np.ndarray:
    """For each bin the order in which an empty one looks for a filled one: the same for every text."""
    return np.stack([np.random.default_rng([bins, j]).permutation(bins) for j in range(bins)])


def signatures(rows: np.ndarray, hashes: np.ndarray, n: int, bins: int, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation signatures (n x bins) of sorted distinct hashes; an empty bin takes the value of
    the first filled bin of its own random probe order (optimal densification)."""
    sig, filled = np.zeros((n, bins), np.uint64), np.zeros((n, bins), bool)
    where = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    key = rows * bins + where
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    sig.ravel()[key[first]] = hashes[first]
    filled.ravel()[key[first]] = True
    some = filled.any(axis=1)
    r, b = np.nonzero(~filled & some[:, None])
    for at in range(0, len(r), 20_000):
        rr, bb = r[at : at + 20_000], b[at : at + 20_000]
        seen = filled[rr[:, None], probe[bb]]
        sig[rr, bb] = sig[rr, probe[bb, seen.argmax(axis=1)]]
    return sig, some


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407), (len(sig), bands)).copy()
    parts = sig.reshape(len(sig), bands, rows)
    for j in range(rows):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return h


def _sketch(width: int, bands: int, rows: int):
    def run(batches):
        import pyarrow as pa

        probe = _probe_order(bands * rows)
        for batch in batches:
            raw, offsets, nulls = letters_of(batch, 1)
            ids = batch.column(0)
            for lo, hi in row_slices(offsets, _SLICE):
                n = hi - lo
                r, h = shingle_hashes(*word_hashes(raw, offsets[lo : hi + 1]), width)
                count = np.bincount(r, minlength=n).astype(np.int64)
                sums = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                for k, s in enumerate(sums):
                    np.add.at(s, r, mix(h ^ np.uint64((0x5851F42D4C957F2D, 0x14057B7EF767814F)[k])))
                sig, some = signatures(r, h, n, bands * rows, probe)
                keys = band_keys(sig, bands, rows)[some].view(np.int64)
                ends = np.r_[0, np.cumsum(some * bands)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), pa.array(count), *(pa.array(s.view(np.int64)) for s in sums), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    names=["doc_id", "n_shingles", "h1", "h2", "bands"],
                )

    return run


def _sets(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, offsets, _ = letters_of(batch, 1)
            for lo, hi in row_slices(offsets, _SLICE):
                r, h = shingle_hashes(*word_hashes(raw, offsets[lo : hi + 1]), width)
                ends = np.r_[0, np.cumsum(np.bincount(r, minlength=hi - lo))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))], names=["id", "set"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, of every id in edges (a, b). Alternating large-star and
    small-star steps, each written to the shared folder; ends when the edges no longer change."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = materialise(e)
    mark = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = large.join(least, F.col("a") == F.col("k")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        was, e = e, materialise(small.union(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct())
        forget(was)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        mark = now


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are that similar."""
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    texts = docs.join(small_side(ids), docs["doc_id"] == ids["id"], "left_semi")
    sets = texts.mapInArrow(_sets(width), "id long, set array<long>")
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialise(docs.mapInArrow(_sketch(width, bands, rows), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"))
    addressed = sketch.filter("doc_id is not null and n_shingles > 0")
    reps = materialise(addressed.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "bands")).alias("r")).select("h1", "h2", "n_shingles", F.col("r.doc_id").alias("rep"), F.col("r.bands").alias("bands")))
    member = reps.select(F.explode("bands").alias("band"), F.col("rep").alias("id"), F.col("n_shingles").alias("n"))
    buckets = member.groupBy("band").agg(F.min("id").alias("a"), F.count("*").alias("m")).filter("m > 1").select(F.col("band").alias("key"), "a")
    shared = materialise(member.join(buckets, F.col("band") == F.col("key")).select("band", "id", "n", "a"))
    star = materialise(shared.filter("id <> a").select("a", F.col("id").alias("b")).distinct())
    links = _confirmed(star, docs, width, percent)
    # a doc_id with several texts is one document
    rep_of = addressed.select("h1", "h2", "doc_id").join(reps.select("h1", "h2", "rep"), ["h1", "h2"])
    same = rep_of.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x <> y")
    same = rep_of.join(same.select("doc_id", "x"), "doc_id").filter("rep <> x").select(F.col("rep").alias("a"), F.col("x").alias("b"))
    links = materialise(links.union(same).distinct())
    found = materialise(components(links))
    more = materialise(_untested(shared, found, docs, width, percent, bands, rows))
    if more.head(1):
        new = materialise(_confirmed(more, docs, width, percent))
        if new.head(1):
            found = materialise(components(links.union(new)))
    out = sketch.join(reps.select("h1", "h2", F.col("n_shingles").alias("n_rep"), "rep"), (sketch["h1"] == reps["h1"]) & (sketch["h2"] == reps["h2"]) & (sketch["n_shingles"] == F.col("n_rep")) & sketch["doc_id"].isNotNull(), "left").select("doc_id", "n_shingles", "rep")
    out = out.join(found, out["rep"] == found["id"], "left")
    component = F.coalesce("component", "rep", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _profiles(width: int, bands: int, rows: int):
    """For each text: its shingles counted by CELLS hash cells (of the least width that holds them), and its band keys."""

    def run(batches):
        import pyarrow as pa

        probe = _probe_order(bands * rows)
        for batch in batches:
            raw, offsets, _ = letters_of(batch, 1)
            for lo, hi in row_slices(offsets, _SLICE):
                n = hi - lo
                r, h = shingle_hashes(*word_hashes(raw, offsets[lo : hi + 1]), width)
                cells = np.bincount(r * CELLS + (h & np.uint64(CELLS - 1)).astype(np.int64), minlength=n * CELLS).reshape(n, CELLS)
                keys = band_keys(signatures(r, h, n, bands * rows, probe)[0], bands, rows)
                fit = [c.astype(np.uint8 if c.max() < 256 else np.uint32).tobytes() for c in cells]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(fit, pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary())], names=["id", "cells", "keys"])

    return run


def _survivors(percent: int, banded: bool):
    """Of each block of a group (rows sorted by key, i, j), the pairs outside-member that differ in component and may be
    similar enough by length and by their cells (a proof, not an estimate), one of them at least being `near` and not
    the longer. banded: keys are bands, and a pair counts in its first shared band alone."""

    def compare(rows) -> list[tuple[int, int]]:
        key = rows["key"][0]
        n, ids, comp, near = rows["n"], rows["id"], rows["component"], rows["near"]
        cells = [np.frombuffer(c, np.uint8 if len(c) == CELLS else np.uint32) for c in rows["cells"]]
        wide = any(c.dtype != np.uint8 for c in cells)
        cells = np.stack(cells).astype(np.int64 if wide else np.int16)
        keys = np.stack([np.frombuffer(k, np.int64) for k in rows["keys"]])
        left, right = np.flatnonzero(rows["outside"]), np.flatnonzero(~rows["outside"])
        out = []
        for x in left:
            y = right[comp[right] != comp[x]]
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            y = y[(near[x] & (n[x] <= n[y])) | (near[y] & (n[y] <= n[x]))]
            total = n[y] + n[x]
            most = (total - np.abs(cells[y] - cells[x]).sum(axis=1)) // 2
            y = y[100 * most >= percent * (total - most)]
            if banded and len(y):
                y = y[keys[x][(keys[y] == keys[x]).argmax(axis=1)] == key]
            if len(y):
                out += [(min(ids[x], ids[k]), max(ids[x], ids[k])) for k in y]
        return out

    def run(batches):
        import pyarrow as pa

        names, held = ["key", "i", "j", "outside", "id", "n", "component", "near", "cells", "keys"], None

        def columns(t):
            return {c: np.array(t.column(c).to_pylist(), object) if c in ("cells", "keys") else t.column(c).to_numpy(zero_copy_only=False) for c in names}

        def done(t):
            c = columns(t)
            cut = np.flatnonzero((np.diff(c["key"]) != 0) | (np.diff(c["i"]) != 0) | (np.diff(c["j"]) != 0)) + 1
            pairs = []
            for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(c["key"])], strict=True):
                pairs += compare({k: v[lo:hi] for k, v in c.items()})
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.concat_batches([held, batch]) if held is not None else batch
            last = [held.column(k)[held.num_rows - 1].as_py() for k in range(3)]
            same = np.logical_and.reduce([held.column(k).to_numpy(zero_copy_only=False) == last[k] for k in range(3)])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield done(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield done(held)

    return run


def _rarest(who: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, id, n, near): of each text of who its rarest shingles, by their number of texts. Of n shingles, similar texts
    share at least percent in a hundred, so each text needs only the first of the rest and one more; a shingle of a single
    text takes its place among them but isn't returned.

    With a partner that isn't shorter, a text of n shingles shares at least 2 * percent * n / (100 + percent), so the first
    shingle that the two share stands so much earlier in the text: `near` marks those places."""
    texts = docs.join(small_side(who), docs["doc_id"] == who["id"], "left_semi")
    each = texts.mapInArrow(_sets(width), "id long, set array<long>").select("id", F.size("set").cast("long").alias("n"), F.xxhash64("set").alias("of"), F.explode("set").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    ranked = each.join(often, "key").groupBy("id", "of", "n").agg(F.array_sort(F.collect_list(F.struct("c", "key"))).alias("s"))
    single = F.col("n") - F.size("s")
    most = (F.col("n") - F.call_function("div", percent * F.col("n") + 99, F.lit(100)) + 1 - single).cast("int")
    places = ranked.select("id", "n", single.alias("single"), F.posexplode(F.slice("s", F.lit(1), F.greatest(most, F.lit(0)))).alias("at", "s"))
    near = F.col("single") + F.col("at") + 1 <= F.col("n") - F.call_function("div", 2 * percent * F.col("n") + 99 + percent, F.lit(100 + percent)) + 1
    return places.select("s.key", "id", "n", near.alias("near")).distinct()


def _in_blocks(groups: DataFrame, docs: DataFrame, width: int, percent: int, bands: int, rows: int, banded: bool) -> DataFrame:
    """Possible links (a, b) within groups (key, id, n, component, near, home, m, far): of each group of m members those
    outside the component `home` meet all of other components, in blocks of at most about BLOCK by BLOCK. Members that
    aren't near meet only those that are; far: whether the group has such members."""
    groups = materialise(groups)
    ids = materialise(groups.select("id").distinct())
    side = docs.join(small_side(ids), docs["doc_id"] == ids["id"], "left_semi").mapInArrow(_profiles(width, bands, rows), "id long, cells binary, keys binary")
    blocks = F.call_function("div", F.col("m") + BLOCK - 1, F.lit(BLOCK)).cast("int")
    mine, all_ = F.pmod(F.xxhash64("id"), blocks).cast("int"), F.sequence(F.lit(0), blocks - 1)
    keep = ["key", "id", "n", "component", "near"]
    # near ones have the blocks before `blocks`, the others those from there on
    mine_or_later = mine + F.when(F.col("near"), 0).otherwise(blocks)
    left = groups.filter("component <> home").select(*keep, F.lit(True).alias("outside"), mine_or_later.alias("i"), F.explode(all_).alias("j"))
    met = F.sequence(F.lit(0), F.when(F.col("near") & F.col("far"), 2 * blocks).otherwise(blocks) - 1)
    right = groups.select(*keep, F.lit(False).alias("outside"), mine.alias("j"), F.explode(met).alias("i"))
    both = left.unionByName(right).join(side, "id").select("key", "i", "j", "outside", "id", "n", "component", "near", "cells", "keys")
    both = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return both.mapInArrow(_survivors(percent, banded), "a long, b long").distinct()


def _untested(shared: DataFrame, found: DataFrame, docs: DataFrame, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Pairs (a, b) within a bucket, of different components, that no star edge has tested and that may be links.

    Buckets of at most BLOCK members are one block each. The members of larger ones are grouped by their rarest
    shingles instead; a shingle that is near to none of them can't be the first that two similar texts share. Where
    more than BLOCK of them have another one among their rarest, those members alone are compared in their buckets
    after all, in several blocks."""
    placed = shared.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = placed.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.max(F.when(F.col("id") == F.col("a"), F.col("component"))).alias("home"), F.count("*").alias("m")).filter("least <> most").select("band", "home", "m")
    placed = placed.join(split, "band").filter("id <> a").withColumnRenamed("band", "key")
    placed = materialise(placed.withColumns({"near": F.lit(True), "far": F.lit(False)}))
    few = _in_blocks(placed.filter(F.col("m") <= BLOCK), docs, width, percent, bands, rows, True)
    who = materialise(placed.filter(F.col("m") > BLOCK).select("id", "component").distinct())
    if not who.head(1):
        return few
    rare = materialise(_rarest(who, docs, width, percent).join(who, "id"))
    apart = rare.groupBy("key").agg(F.min("component").alias("home"), F.max("component").alias("most"), F.count("*").alias("m"), F.bool_or("near").alias("any_near"), F.bool_or(~F.col("near")).alias("far"))
    apart = materialise(apart.filter("home <> most and any_near").drop("most", "any_near"))
    out = few.union(_in_blocks(rare.join(apart.filter(F.col("m") <= BLOCK), "key"), docs, width, percent, bands, rows, False))
    # what shares a shingle that is rare to too many stays in its bucket, in blocks
    hot = materialise(rare.join(apart.filter(F.col("m") > BLOCK).select("key"), "key").select("id").distinct())
    if hot.head(1):
        held = placed.filter(F.col("m") > BLOCK).join(small_side(hot), "id", "left_semi")
        out = out.union(_in_blocks(held.select(*placed.columns), docs, width, percent, bands, rows, True))
    return out.distinct()


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: the one with the smallest doc_id. All columns stay; of rows
    that share that doc_id, the one whose columns hash lowest. Rows with a null doc_id stay."""
    found = materialise(near_duplicates(docs, width, percent).select("doc_id", "kept"))
    (gone,) = fresh(docs, "gone_id")
    lost = materialise(found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct())
    left = docs.join(small_side(lost), docs["doc_id"] == F.col(gone), "left_anti")
    twice = materialise(found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(gone)))
    if not twice.head(1):
        return left
    again = left.join(small_side(twice), left["doc_id"] == F.col(gone), "left_semi")
    once = left.join(small_side(twice), left["doc_id"] == F.col(gone), "left_anti")
    (at,) = fresh(docs, "at")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    return once.unionByName(again.withColumn(at, F.row_number().over(order)).filter(F.col(at) == 1).drop(at))
