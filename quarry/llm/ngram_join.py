"""Exact n-gram Jaccard join by vertical partitioning of the n-gram order.

N-grams are ordered by a 64-bit hash. That global order is cut into fragments, so a set
becomes one segment a fragment, and counts are taken fragment by fragment:

1. Counts. Tasks pack the segments of a block of sets, sorted and delta-coded, into one row a
   fragment. A fragment counts in how many sets each of its n-grams stands and sends back
   the segments without the n-grams that stand in one set only, with the class (the
   logarithm) of each other one's count.
2. Keys. Two linked sets share at least t of the larger one's n-grams, so a set with fewer than
   ceil(t n) repeated n-grams has no partner. Of another one the first r - ceil(t n) + 1 of its
   r repeated n-grams are its keys, rarest class first: linked sets share one. Passages that
   many texts quote come last and gather no crowds.
3. Pivots. Sets that share a key are not all paired. The set with the most company among
   them is their pivot and each other one is paired with it: rows grow linearly.
4. Partial overlaps. The n-grams of a pair meet slice by slice of the order; overlaps are counted
   separately and summed by pair. Each set is tested with its foremost pivot; then only pairs
   that are not connected yet are.
5. The rest. Two members of a pivot of which one is not connected to it may still link. They do
   only if their *differences* to the pivot overlap by known amounts, so prefixes of the
   differences (n-grams new to the pivot first, as the rarer ones) are joined; what is connected
   already and what the sizes, the places of a shared n-gram or the triangle inequality rule out
   is left out, and the distance follows from the differences exactly.
6. Links are closed by connected components, over classes of equal sets; copies are joined
   back at the end, salted.

A fragment has about FRAGMENT n-grams up to MOST_FRAGMENTS fragments and grows with the data beyond;
a task holds one of them (24 bytes an n-gram).

Defined results: null or empty text, or text without words, has no n-grams, is linked with
nothing and is its own component; fewer words than n make one n-gram; repeated rows are in
one class; a null id never is a component's name unless all its rows lack an id; an empty
table gives an empty result; extra columns do not matter. Sets are known by 128 bits; should
two sets share the first 64 bits the job fails instead of merging them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import textvec
from quarry.llm.common import remove, small_batches, written
from quarry.llm.components import components
from quarry.llm.textvec import U64, mix

N, PERCENT = 5, 80
SLICES, SALTS = 4, 64
#: N-grams in a block of sets and, while they are fewer than MOST_FRAGMENTS, in a fragment.
BLOCK, FRAGMENT, MOST_FRAGMENTS = 1 << 19, 1 << 18, 1 << 16
#: Set ids that a task remembers so that its own copies are written once.
REMEMBER = 1_000_000


def sets(w: textvec.Words, n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, n-gram (ascending within a document) and set size of each document of w."""
    docs, grams = [], []
    for size in range(1, n + 1):
        d, h = textvec.windows(w, size)
        if size < n:
            keep = w.count[d] == size
            d, h = d[keep], h[keep]
        docs.append(d)
        grams.append(h)
    d, h = np.concatenate(docs), np.concatenate(grams)
    order = np.argsort(h)
    d, h = d[order], h[order]
    order = np.argsort(d.astype(np.int32), kind="stable")
    d, h = d[order], h[order]
    if len(d):
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
        d, h = d[new], h[new]
    return d, h, np.bincount(d, minlength=len(w.count))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum modulo 2**64 of each document's values; values are grouped by document."""
    out = np.zeros(len(sizes), U64)
    full = sizes > 0
    if len(values):
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        with np.errstate(over="ignore"):
            out[full] = np.add.reduceat(values, starts)
    return out


def names(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as two signed 64-bit numbers."""
    first = mix(_sums(mix(grams ^ U64(0x5851F42D4C957F2D)), sizes) + sizes.astype(U64))
    second = mix(_sums(mix(grams ^ U64(0x14057B7EF767814F)), sizes) + sizes.astype(U64))
    return first.view(np.int64), second.view(np.int64)


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _fresh(cid: np.ndarray, sizes: np.ndarray, seen: set) -> np.ndarray:
    """Which rows have n-grams and a set that the task has not seen yet."""
    out = np.zeros(len(cid), bool)
    for i, (c, n) in enumerate(zip(cid.tolist(), sizes.tolist())):
        if n and c not in seen:
            out[i] = True
            seen.add(c)
    if len(seen) > REMEMBER:
        seen.clear()
    return out


def members(docs: DataFrame, n: int = N, extra: str = "") -> DataFrame:
    """doc_id, n_shingles and the two names of each row's set; extra: further columns of docs, as a schema of longs."""
    more = [c.split()[0] for c in extra.split(", ") if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, w in textvec.chunks(b.column(1), textvec.LOWER):
                _, grams, sizes = sets(w, n)
                cid, check = names(grams, sizes)
                own = [b.column(2 + k)[lo:hi] for k in range(len(more))]
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(sizes.astype(np.int64)), pa.array(cid), pa.array(check), *own], names=["doc_id", "n", "cid", "second", *more])

    return docs.select(F.col("doc_id").cast("long"), "text", *more).mapInArrow(run, "doc_id long, n long, cid long, second long" + f", {extra}" * bool(extra))


def pack(values: np.ndarray, docs: np.ndarray) -> bytes:
    """Ascending 64-bit values with the document of each, as byte planes of their differences, which compress."""
    steps = np.diff(values, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    places = docs.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return np.concatenate([steps.ravel(), places.ravel()]).tobytes()


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(body, np.uint8).reshape(12, -1)
    steps = np.ascontiguousarray(planes[:8].T).view("<u8").ravel()
    return np.cumsum(steps, dtype=U64), np.ascontiguousarray(planes[8:].T).view("<u4").ravel()


def classes(counts: np.ndarray) -> np.ndarray:
    """The class of n-grams that stand in so many sets: 0 for one, else the bits of the count less one."""
    return np.frexp(np.maximum(counts, 1) - 1)[1].astype(np.uint8)


def prefix_keys(doc: np.ndarray, grams: np.ndarray, kinds: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated n-grams with their class, by document -> (document, n-gram) of the keys; sizes has all n-grams of each document."""
    order = np.lexsort((grams, kinds, doc))
    doc, grams = doc[order], grams[order]
    repeated = np.bincount(doc, minlength=len(sizes))
    many = repeated - -(-sizes * percent // 100) + 1
    place = np.arange(len(doc)) - np.repeat(np.cumsum(repeated) - repeated, repeated)
    keep = place < many[doc]
    return doc[keep], grams[keep]


def segments(docs: DataFrame, fragments: int, n: int) -> DataFrame:
    """(frag, block, body): the sets of a block cut into fragments; a negative fragment has their names and sizes. A task writes a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen: set = set()
        block, held = TaskContext.get().partitionId() << 32, 0
        names_: list[np.ndarray] = []
        sizes_: list[np.ndarray] = []
        grams_: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            sizes, grams = np.concatenate(sizes_), np.concatenate(grams_)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(grams)
            grams, doc = grams[order], doc[order]
            frag = ((grams >> U64(32)) * U64(fragments)) >> U64(32)
            edges = np.searchsorted(frag, np.arange(fragments + 1, dtype=U64))
            own = np.flatnonzero(np.diff(edges))
            bodies = [pack(grams[edges[f] : edges[f + 1]], doc[edges[f] : edges[f + 1]]) for f in own.tolist()]
            bodies.append(np.concatenate([np.concatenate(names_), sizes]).astype("<i8").tobytes())
            frags = pa.array(np.append(own, -1 - block % 997).astype(np.int32))
            return pa.RecordBatch.from_arrays([frags, pa.array(np.full(len(bodies), block)), pa.array(bodies, pa.binary())], names=["frag", "block", "body"])

        for b in batches:
            for _, _, w in textvec.chunks(b.column(0), textvec.LOWER):
                doc, grams, sizes = sets(w, n)
                cid, _ = names(grams, sizes)
                fresh = _fresh(cid, sizes, seen)
                if not fresh.any():
                    continue
                names_.append(cid[fresh])
                sizes_.append(sizes[fresh])
                grams_.append(grams[fresh[doc]])
                held += len(grams_[-1])
                if held >= BLOCK:
                    yield flush()
                    block, held, names_, sizes_, grams_ = block + 1, 0, [], [], []
        if names_:
            yield flush()

    return docs.select("text").mapInArrow(run, "frag int, block long, body binary")


def repeated(rows: DataFrame) -> DataFrame:
    """Segments without the n-grams of one set; the bodies get a class for each n-gram at their end."""

    def run(table: pa.Table) -> pa.Table:
        if table["frag"][0].as_py() < 0:
            return table
        parts = [unpack(x) for x in table["body"].to_pylist()]
        values, docs = np.concatenate([v for v, _ in parts]), np.concatenate([d for _, d in parts])
        part = np.repeat(np.arange(len(parts)), [len(v) for v, _ in parts])
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        counts = np.diff(np.append(starts, len(ranked)))
        kinds = np.empty(len(values), np.uint8)
        kinds[order] = np.repeat(classes(counts), counts)
        keep = kinds > 0
        values, docs, part, kinds = values[keep], docs[keep], part[keep], kinds[keep]
        edges = np.searchsorted(part, np.arange(len(parts) + 1))
        own = np.flatnonzero(np.diff(edges)).tolist()
        bodies = [pack(values[edges[k] : edges[k + 1]], docs[edges[k] : edges[k + 1]]) + kinds[edges[k] : edges[k + 1]].tobytes() for k in own]
        return pa.table({"frag": table["frag"].take(pa.array(own, pa.int64())), "block": table["block"].take(pa.array(own, pa.int64())), "body": pa.array(bodies, pa.binary())})

    return rows.groupBy("frag").applyInArrow(run, "frag int, block long, body binary")


def with_keys(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, n, keys, grams) of each set that can have a partner: its keys, and its repeated n-grams in ascending order."""

    def run(table: pa.Table) -> pa.Table:
        frags, bodies = table["frag"].to_pylist(), table["body"].to_pylist()
        head = next(np.frombuffer(x, "<i8") for f, x in zip(frags, bodies) if f < 0)
        cid, sizes = head[: len(head) // 2], head[len(head) // 2 :]
        parts = []
        for f, x in sorted((f, x) for f, x in zip(frags, bodies) if f >= 0):
            m = len(x) // 13
            parts.append((*unpack(x[: 12 * m]), np.frombuffer(x, np.uint8, m, 12 * m)))
        grams, doc, kinds = (np.concatenate([p[k] for p in parts]) if parts else np.empty(0, t) for k, t in enumerate((U64, np.uint32, np.uint8)))
        doc = doc.astype(np.int64)
        can = np.bincount(doc, minlength=len(sizes)) * 100 >= sizes * percent
        keep = can[doc]
        grams, doc, kinds = grams[keep], doc[keep], kinds[keep]
        key_doc, keys = prefix_keys(doc, grams, kinds, sizes, percent)
        order = np.argsort(doc, kind="stable")  # fragments ascend, and so do the n-grams of a document
        own = np.flatnonzero(can)
        count = lambda d: np.bincount(d, minlength=len(sizes))[own]
        return pa.table({"cid": pa.array(cid[own]), "n": pa.array(sizes[own]), "keys": _lists(count(key_doc), keys.view(np.int64)), "grams": _lists(count(doc), grams[order].view(np.int64))})

    return rows.groupBy("block").applyInArrow(run, "cid long, n long, keys array<long>, grams array<long>")


def candidates(docs: DataFrame, total: int, n: int, percent: int) -> DataFrame:
    """The written sets that can have a partner; see with_keys(). total: n-grams of all rows."""
    fragments = max(1, min(-(-total // FRAGMENT), MOST_FRAGMENTS))
    return written(with_keys(repeated(segments(docs, fragments, n)), percent), "join-sets")[0]


def star_pairs(found: DataFrame) -> DataFrame:
    """(p, m, n_p, n_m, weight): each set with the pivots of its keys; weight: the pivot's company."""
    spark = found.sparkSession
    # A set whose copies lie in several blocks is there several times.
    rows, first = written(found.select(F.explode("keys").alias("key"), "cid", "n").groupBy("key", "cid").agg(F.max("n").alias("n")), "join-keys")
    company, second = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("company")).where("company > 1"), "join-company")
    active, third = written(rows.join(company, "key"), "join-active")
    popular, fourth = written(active.groupBy("cid").agg(F.sum("company").alias("popular")), "join-popular")
    ranked = active.join(popular, "cid")
    pivots, fifth = written(ranked.groupBy("key").agg(F.max(F.struct("popular", "cid", "n")).alias("pivot")), "join-pivots")
    pairs = (
        active.join(pivots, "key")
        .where(F.col("cid") != F.col("pivot.cid"))
        .groupBy(F.col("pivot.cid").alias("p"), F.col("cid").alias("m"))
        .agg(F.max("pivot.n").alias("n_p"), F.max("n").alias("n_m"), F.max("pivot.popular").alias("weight"))
    )
    out, _ = written(pairs, "join-pairs")
    for path in (first, second, third, fourth, fifth):
        remove(spark, path)
    return out


def overlaps(grams: DataFrame, pairs: DataFrame, differences: bool = False) -> DataFrame:
    """pairs (p, m, ...) with their overlap, from partial overlaps slice by slice; with the member's differences to its pivot, extra and missing, on demand.

    grams (cid, grams) has the n-grams that more than one set has; those of one set overlap with nothing and are in no difference.
    """
    salt = F.pmod("m", F.lit(SALTS)).cast("int").alias("salt")
    both = pairs.select("p", "m", salt).join(grams, pairs["m"] == grams["cid"]).select("p", "m", "salt", "grams")
    # A pivot goes to the salts that its members use, and nowhere else.
    places = pairs.select("p", salt).distinct()
    heads = places.join(grams, places["p"] == grams["cid"]).select("p", F.lit(None).cast("long").alias("m"), "salt", "grams")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            values = lists.flatten().to_numpy().view(U64)
            sizes = np.diff(lists.offsets.to_numpy())
            at = np.repeat(np.arange(b.num_rows), sizes) * SLICES + (values >> U64(62)).astype(np.int64)  # SLICES equal ranges of the order
            counts = np.bincount(at, minlength=b.num_rows * SLICES)
            rows = pa.array(np.repeat(np.arange(b.num_rows), SLICES))
            slices = pa.array(np.tile(np.arange(SLICES, dtype=np.int32), b.num_rows))
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(rows) for k in range(3)], slices, _lists(counts, values.view(np.int64))], names=["p", "m", "salt", "slice", "grams"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, head = None, None
        for b in batches:
            p, m, salts, part = (b.column(k).to_pylist() for k in range(4))
            lists = b.column(4)
            values, ends = lists.flatten().to_numpy().view(U64), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            out = []
            for i in range(b.num_rows):
                own = values[ends[i] : ends[i + 1]]
                if m[i] is None:
                    name, head = (p[i], salts[i], part[i]), own
                    continue
                if name != (p[i], salts[i], part[i]):
                    raise ValueError("a member came without its pivot")
                spot = np.searchsorted(head, own)
                same = np.zeros(len(own), bool)
                inside = spot < len(head)
                same[inside] = head[spot[inside]] == own[inside]
                extra, missing = own[:0], own[:0]
                if differences:
                    gone = np.ones(len(head), bool)
                    gone[spot[same]] = False
                    extra, missing = own[~same], head[gone]
                out.append((p[i], m[i], int(same.sum()), extra.view(np.int64), missing.view(np.int64)))
            if out:
                longs = pa.list_(pa.int64())
                kinds = (pa.int64(), pa.int64(), pa.int64(), longs, longs)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["p", "m", "overlap", "extra", "missing"])

    order = ["p", "salt", "slice", F.col("m").asc_nulls_first()]
    met = (
        both.unionByName(heads)
        .mapInArrow(cut, "p long, m long, salt int, slice int, grams array<long>")
        .repartition("p", "salt", "slice")
        .sortWithinPartitions(*order)
        .mapInArrow(compare, "p long, m long, overlap long, extra array<long>, missing array<long>")
    )
    figures = [F.sum("overlap").alias("overlap")]
    if differences:
        figures += [F.flatten(F.collect_list(c)).alias(c) for c in ("extra", "missing")]  # SLICES rows a pair
    summed, used = written(met.groupBy("p", "m").agg(*figures), "join-overlaps")
    out, _ = written(pairs.join(summed, ["p", "m"]), "join-tested")
    remove(pairs.sparkSession, used)
    return out


def _linked(overlap: F.Column, a: F.Column, b: F.Column, percent: int) -> F.Column:
    return 100 * overlap >= percent * (a + b - overlap)


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """pairs with label_p and label_m: the components of both sets so far, their own names if they have none."""
    for c in "pm":
        own = labels.select(F.col("node").alias(f"_{c}"), F.col("label").alias(f"label_{c}"))
        pairs = pairs.join(own, pairs[c] == own[f"_{c}"], "left").drop(f"_{c}").withColumn(f"label_{c}", F.coalesce(f"label_{c}", c))
    return pairs


def labels(docs: DataFrame, total: int, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(node, label) of all sets that have a link: the least set that links lead to."""
    spark = docs.sparkSession
    found = candidates(docs, total, n, percent)
    pairs = star_pairs(found)
    needed = pairs.select(F.col("p").alias("cid")).unionByName(pairs.select(F.col("m").alias("cid"))).distinct()
    grams, used = written(found.select("cid", "grams").join(needed, "cid", "left_semi").dropDuplicates(["cid"]), "join-grams")
    edges = lambda tested: tested.where(_linked(F.col("overlap"), F.col("n_p"), F.col("n_m"), percent)).select(F.col("p").alias("u"), F.col("m").alias("v"))
    known = lambda table: table.select(F.col("node").alias("u"), F.col("label").alias("v"))
    near = (100 * F.col("n_p") >= percent * F.col("n_m")) & (100 * F.col("n_m") >= percent * F.col("n_p"))

    foremost = pairs.where(near).groupBy("m").agg(F.max(F.struct("weight", "p", "n_p", "n_m")).alias("best"))
    foremost, _ = written(foremost.select("best.p", "m", "best.n_p", "best.n_m"), "join-foremost")
    now, _ = written(components(edges(overlaps(grams, foremost))), "join-labels")

    others = pairs.where(near).join(foremost.select("m", F.col("p").alias("tested")), "m").where(F.col("p") != F.col("tested"))
    others, _ = written(_labelled(others.select("p", "m", "n_p", "n_m"), now).where("label_p <> label_m").drop("label_p", "label_m"), "join-others")
    if not others.isEmpty():
        now, _ = written(components(edges(overlaps(grams, others)).unionByName(known(now))), "join-labels")

    # Pivots with a member that is not connected to them, and any other member.
    apart, _ = written(_labelled(pairs.select("p", "m", "n_p", "n_m"), now), "join-apart")
    loose = apart.groupBy("p").agg(F.count_if(F.col("label_p") != F.col("label_m")).alias("loose"), F.count(F.lit(1)).alias("members"))
    rest = apart.join(loose.where("loose > 0 and members > 1").select("p"), "p", "left_semi")
    rest, _ = written(rest, "join-rest")
    if not rest.isEmpty():
        more = residual(overlaps(grams, rest, differences=True), percent)
        now, _ = written(components(more.unionByName(known(now))), "join-labels")
    remove(spark, used)
    return now


def residual(tested: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between members of one pivot that lie in different components so far.

    tested: all pairs of such pivots with overlap, differences and both components. The pivot's own n-grams,
    that no other set has, are missing from all members; numbers from 1 stand for them. A member's own
    ones are shared with nobody and only count in the size of its difference.
    """
    lone = (F.col("n_p") - F.col("overlap") - F.size("missing")).cast("long")
    own = F.when(lone > 0, F.sequence(F.lit(1).cast("long"), lone)).otherwise(F.array().cast("array<long>"))
    union = F.col("n_p") + F.col("n_m") - F.col("overlap")
    rows = tested.select(
        "p", "m", "n_m", "label_m", (F.col("label_p") != F.col("label_m")).alias("loose"),
        _linked(F.col("overlap"), F.col("n_p"), F.col("n_m"), percent).alias("linked"),
        # A partner that is linked to the pivot is at most 1 - t from it, and so must be within 2 (1 - t).
        (100 * F.col("overlap") >= (2 * percent - 100) * union).alias("within"),
        (F.col("n_p") + F.col("n_m") - 2 * F.col("overlap")).alias("size"),
        F.concat(F.sort_array("extra"), F.sort_array("missing"), own).alias("diff"),
    )
    size, shown = F.col("size"), F.size("diff")
    # Bounds on the overlap of two differences, of which one belongs to a member that is not linked to the pivot:
    # at_least from that, as_loose from the largest distance that the set's own size allows.
    at_least = F.floor(F.lit(percent) * size / (100 + percent)) + 1
    as_loose = F.greatest(F.lit(1), size - F.floor((100 - percent) * F.col("n_m") / F.lit(percent)))
    prefix = lambda need: F.posexplode(F.slice("diff", 1, F.greatest(F.lit(0), shown - need + 1).cast("int")))

    def prefixes(some: DataFrame, c: str, need: F.Column) -> DataFrame:
        return some.select(
            "p", *[F.col(k).alias(f"{k}_{c}") for k in ("n_m", "label_m", "linked", "within", "loose", "size")],
            F.col("m").alias(c), shown.alias(f"shown_{c}"), prefix(need).alias(f"at_{c}", "gram"),
        )

    # The largest distance of a linked pair, and so the least overlap of the differences.
    most = F.floor((100 - percent) * (F.col("n_m_a") + F.col("n_m_b")) / F.lit(100 + percent))
    need = F.ceil((F.col("size_a") + F.col("size_b") - most) / F.lit(2))
    left_over = F.least(F.col("shown_a") - F.col("at_a"), F.col("shown_b") - F.col("at_b"))  # from a first shared n-gram on
    met = (
        prefixes(rows.where("loose"), "a", as_loose)
        .join(prefixes(rows, "b", F.greatest(at_least, as_loose)), ["p", "gram"])
        .where((F.col("label_m_a") != F.col("label_m_b")) & (~F.col("loose_b") | (F.col("a") < F.col("b"))))
        .where((~F.col("linked_b") | F.col("within_a")) & (~F.col("linked_a") | F.col("within_b")))
        .where((100 * F.col("n_m_a") >= percent * F.col("n_m_b")) & (100 * F.col("n_m_b") >= percent * F.col("n_m_a")))
        .where((F.abs(F.col("size_a") - F.col("size_b")) <= most) & (left_over >= need))
        .select("p", "a", "b")
        .distinct()
    )
    side = lambda c: rows.select("p", F.col("m").alias(c), F.col("diff").alias(f"diff_{c}"), F.col("n_m").alias(f"n_{c}"), F.col("size").alias(f"size_{c}"))
    judged = met.join(side("a"), ["p", "a"]).join(side("b"), ["p", "b"])
    apart = F.col("size_a") + F.col("size_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    overlap = (F.col("n_a") + F.col("n_b") - apart) / 2
    return judged.where(_linked(overlap, F.col("n_a"), F.col("n_b"), percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))


#: What tells texts of one doc_id apart: 128 bits of the text. The names are unlikely in a table of documents.
TEXT_KEY = ("_text_key", "_text_key_2")


def with_text_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({TEXT_KEY[0]: F.xxhash64("text"), TEXT_KEY[1]: F.xxhash64(F.lit(1), "text")})


def redundant(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(doc_id, *TEXT_KEY) of the rows with n-grams that are not their component's first.

    The first has the smallest doc_id, null last, and of one doc_id the smallest text key.
    """
    rows = _components(with_text_key(docs), n, percent, TEXT_KEY)
    is_first = F.lit(True)
    for c in ("doc_id", *TEXT_KEY):
        is_first &= F.col(c).eqNullSafe(F.col(f"component.{c}"))
    return rows.where((F.col("n") > 0) & ~is_first).select("doc_id", *TEXT_KEY).distinct()


def join(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and the class of equal sets of each row."""
    return _components(docs, n, percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("cid").alias("class_id"),
    )


def _components(docs: DataFrame, n: int, percent: int, text_key: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n, cid and component of each row: the component's least doc_id or, given a text key, its first row as a struct."""
    small_batches(docs.sparkSession)
    rows, _ = written(members(docs, n, ", ".join(f"{c} long" for c in text_key)), "join-members")
    total = rows.agg(F.sum("n")).first()[0] or 0
    known = labels(docs, total, n, percent)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", *text_key), F.lit(SALTS)).cast("int"))
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *text_key) if text_key else F.col("doc_id")
    local = rows.where("n > 0").groupBy("cid", "salt").agg(F.min(least).alias("least"), F.min("second").alias("low"), F.max("second").alias("high"))
    local, _ = written(local, "join-local")
    classes = local.groupBy("cid").agg(F.min("least").alias("least"), F.min("low").alias("low"), F.max("high").alias("high"))
    classes = classes.select(
        "cid", F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("two sets share 64 bits"))).otherwise(F.col("least")).alias("least")
    )
    named = classes.join(known, classes["cid"] == known["node"], "left").select("cid", "least", F.coalesce("label", "cid").alias("label"))
    named, _ = written(named, "join-named")
    best = named.groupBy("label").agg(F.min("least").alias("component"))
    named, _ = written(named.join(best, "label").select("cid", "component"), "join-classes")
    spread = local.select("cid", "salt").join(named, "cid")
    return rows.join(spread, ["cid", "salt"], "left").select("doc_id", "n", "cid", *text_key, "component")
