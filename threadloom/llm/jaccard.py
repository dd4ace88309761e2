"""Operator 8: exact n-gram Jaccard join in the metric space of shingle sets.

Distance is 1 - Jaccard. Documents with one and the same set are one node from the start. Document pivots cannot part a corpus
whose texts are nearly all at distance 1 from each other, so the first pivots are single shingles: a node belongs to the regions
of its rarest shingles, as many as a partner within the radius cannot miss (the exact window of that step: of n shingles,
n - ceil(threshold * n) + 1 in any one order). Shingles of a single node take part in no intersection and open no region; they
only use up the window. In each region the least node is the document pivot: all others are measured against it exactly. By the
triangle inequality a node beyond twice the radius from the pivot has no partner in its ball, and of the ball only those can have
one outside that are as far out as the outermost window allows; these boundary nodes are joined again with what is outside, unless
all of them are connected by other regions' links already. Regions that hold the same nodes are joined once.

A region of more than GROUP nodes is joined recursively: its nodes open regions by one more shingle that comes after the first in
the common order, in a window that is one wider (a linked pair's second common shingle cannot lie beyond it), each again with its
pivot, ball and boundary; so on down to DEPTH shingles. What is large even then is cut in pairs of chunks, which is exact too.

In a joined region nodes bring sketches instead of sets: the parities of their numbers of shingles in as many classes as they
have shingles; classes of unlike parity bound the distance from below (a metric too), which leaves few pairs to measure exactly.
Of these a region first names only enough to connect its nodes if all hold; if some don't, it is joined once more with all that
are left. Links lead to components.

Shingles and sets are known by 64-bit hashes. Word hashes of 64 bits go into a shingle's.

Cases: lower case for A-Z only; fewer words than a shingle: the whole sequence is the one shingle; a null text or one without
words has the empty set and links with nothing (component_id is its doc_id); repeated rows have one set, hence distance 0; rows
of one doc_id with different texts are judged each, and the doc_id stands for all of them in component_id; ties: the least doc_id
names a component; a very long text is one slice and one packed row for each bucket; other columns, whatever their names, are not
looked at; rows with a null doc_id are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    LOWER, U64, Tally, bound_batches, byte_view, docs_of, dropped, groups, heavy, lean, member, mix, pack, partitions, shared_dir,
    slices, text_bytes, unpack, word_hashes, word_spans, written,
)
from .components import components

#: Words of a shingle; percent of the union that the intersection must reach.
WIDTH, PERCENT = 5, 80
#: Nodes of a region that one task joins at most; larger ones open regions by one more shingle, DEPTH - 1 times.
GROUP, DEPTH = 4096, 4
#: Text bytes for each bucket of shingles and block of nodes.
BUCKET_BYTES = 8 << 20
#: A shingle in this share of all rows goes by no bucket; so many of these at most.
HEAVY, HOTTEST = 0.002, 1 << 17
#: Bits of a sketch, at least and at most.
LEAST_BITS, MOST_BITS = 64, 8192
SLICE = 4 << 20


def shingle_sets(part: pa.RecordBatch, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice (doc_id, text): distinct shingle hashes of each text, ascending, end to end; where each text's begin; the sets' hashes."""
    data, offsets = byte_view(part.column(1))
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    s = np.zeros(max(0, len(h) - width + 1), dtype=U64)
    for j in range(width):
        s = mix(s * U64(0x9E3779B97F4A7C15) + h[j : len(h) - width + 1 + j]) if len(s) else s
    sets = []
    for a, z in zip(first.tolist(), first[1:].tolist(), strict=False):
        if z - a >= width:
            sets.append(np.unique(s[a : z - width + 1]))
        elif z > a:
            x = U64(z - a)
            with np.errstate(over="ignore"):
                for w in h[a:z]:
                    x = mix(np.array([x * U64(0xD6E8FEB86659FD93) + w]))[0]
            sets.append(np.array([x], dtype=U64))
        else:
            sets.append(np.zeros(0, dtype=U64))
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=U64)
    at = np.r_[0, np.cumsum([len(x) for x in sets])].astype(np.int64)
    return flat, at, node_ids(flat, at)


def node_ids(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set, whatever its order; 0 for the empty one."""
    sums = np.r_[U64(0), np.cumsum(mix(flat ^ U64(0xA0761D6478BD642F)), dtype=U64)]
    return np.where(np.diff(at) > 0, mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(U64)), U64(0)).view(np.int64)


def nodes_of(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash of the text), n_shingles, node for every row; beside them, without a doc_id, the shingles (as node) that are
    in many sets of a slice, and in how many."""
    bound_batches(docs.sparkSession)

    def run(batches):
        lean()
        often = Tally(HEAVY / 4)
        for whole in batches:
            for b in slices(whole, most=SLICE):
                flat, at, node = shingle_sets(b.select(["doc_id", "text"]))
                one = np.unique(node, return_index=True)[1]
                mine = np.zeros(len(node), dtype=bool)
                mine[one] = True
                often.add(flat[np.repeat(mine, np.diff(at))], len(one))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.diff(at)), pa.array(node)], names=["doc_id", "key", "n_shingles", "node"])
        hashes, times = often.result()
        none = pa.nulls(len(hashes), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(times, pa.int64()), pa.array(hashes, pa.int64())], names=["doc_id", "key", "n_shingles", "node"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("key")).mapInArrow(run, "doc_id bigint, key bigint, n_shingles bigint, node bigint")


def shared_shingles(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], size: int) -> DataFrame:
    """block, blob: for a block of nodes, packed: nodes, sizes of their sets, how many shingles follow for each, and these: hashes that
    other nodes have too, with the number of nodes that do.

    Each slice sends each bucket of the hash space one packed row; copies within a slice go once, copies from elsewhere are left
    out in the bucket, so a group of copies counts as one node. What a bucket finds goes on in one piece for each block of nodes.
    The hot shingles (hashes, rough counts), known to be in many sets, need no bucket: they go to the blocks at once (numbered
    -1, -2, ...), so no bucket holds a row for each document of the corpus.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = groups(size, BUCKET_BYTES, 2 * partitions(spark))
    blocks = groups(size, BUCKET_BYTES, partitions(spark))
    handle = spark.sparkContext.broadcast(hot)  # HOTTEST hashes at most

    def cut(batches):
        lean()
        known, df = handle.value
        for whole in batches:
            for b in slices(whole, most=SLICE):
                flat, at, node = shingle_sets(b)
                _, one = np.unique(node, return_index=True)
                one = one[node[one] != 0]
                sizes = np.diff(at)
                if not sizes[one].sum():
                    continue
                keep = np.zeros(len(node), dtype=bool)
                keep[one] = True
                row = np.repeat(np.arange(len(node)), sizes)
                flat, row = flat[keep[row]], row[keep[row]]
                names, blobs = [], []
                place = member(flat, known)
                if (place >= 0).any():
                    here = place >= 0
                    for k, *parts in _by_block(blocks, node, sizes, row[here], flat[here], df[place[here]]):
                        names.append(-1 - k)
                        blobs.append(pack(*parts))
                    flat, row = flat[~here], row[~here]
                bucket = _range(flat, buckets)
                order = np.argsort(bucket, kind="stable")
                flat, row, bucket = flat[order], row[order], bucket[order]
                for p in np.split(np.arange(len(flat)), np.flatnonzero(np.diff(bucket)) + 1) if len(flat) else []:
                    lo, hi = p[0], p[-1] + 1
                    here, counts = np.unique(row[lo:hi], return_counts=True)
                    names.append(int(bucket[lo]))
                    blobs.append(pack(node[here], sizes[here].astype(np.uint32), counts.astype(np.uint32), flat[lo:hi]))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def meet(key, t):
        lean()
        if (block := -1 - key[0].as_py()) >= 0:
            return pa.table({"block": pa.array([block] * t.num_rows, pa.int32()), "blob": t.column("blob")})
        parts = [unpack(x) for x in t.column("blob").to_pylist()]
        node, n, counts, flat = (np.concatenate([p[i] for p in parts]) for i in range(4))
        del parts
        counts = counts.astype(np.int64)
        _, one, which = np.unique(node, return_index=True, return_inverse=True)
        keep = np.zeros(len(node), dtype=bool)
        keep[one] = True
        keep = np.repeat(keep, counts)
        flat, owner = flat[keep], np.repeat(which, counts)[keep]
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        heads = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        times = np.diff(np.r_[heads, len(flat)])
        df = np.repeat(times, times)
        hit = np.flatnonzero(df > 1)
        got = list(_by_block(blocks, node[one], n[one], owner[hit], flat[hit], df[hit]))
        return pa.table({"block": pa.array([x[0] for x in got], pa.int32()), "blob": pa.array([pack(*x[1:]) for x in got], pa.binary())})

    blobs = docs.select("doc_id", "text").filter("text IS NOT NULL").mapInArrow(cut, "bucket int, blob binary")
    return blobs.groupBy("bucket").applyInArrow(meet, "block int, blob binary")


def _range(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def _by_block(blocks: int, node: np.ndarray, n: np.ndarray, owner: np.ndarray, flat: np.ndarray, df: np.ndarray):
    """For each block of nodes: its number, nodes, sizes, counts of what follows for each, hashes, numbers of nodes that have them."""
    block = _range(mix(node.view(U64) ^ U64(0x5851F42D4C957F2D)), blocks)[owner]
    order = np.lexsort((owner, block))
    block, owner, flat, df = block[order], owner[order], flat[order], df[order]
    for p in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(block)) + 1) if len(owner) else []:
        lo, hi = p[0], p[-1] + 1
        heads = lo + np.flatnonzero(np.r_[True, np.diff(owner[lo:hi]) > 0])
        yield int(block[lo]), node[owner[heads]], n[owner[heads]].astype(np.uint32), np.diff(np.r_[heads, hi]).astype(np.uint32), flat[lo:hi], df[lo:hi].astype(np.uint32)


def least_common(n, percent: int = PERCENT):
    """The fewest shingles that a set of n shares with a partner."""
    return (n * percent + 99) // 100


def candidates(shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Nodes that can have a partner at all: node, n, shared (how many of their shingles other nodes have too), shingles (those,
    ascending), their sketch, order (the rarest of them, rarest first), width (how many of these open regions)."""
    kind = "node bigint, n bigint, shared bigint, shingles binary, sketch binary, order array<bigint>, width int"

    def run(key, t):
        lean()
        parts = [unpack(x) for x in t.column("blob").to_pylist()]
        node, n, counts, flat, df = (np.concatenate([p[i] for p in parts]) for i in range(5))
        del parts
        # hot shingles come once from every slice that has the node: one of each
        names, first, which = np.unique(node, return_index=True, return_inverse=True)
        n, owner = n[first].astype(np.int64), np.repeat(which, counts.astype(np.int64))
        sort = np.lexsort((flat, owner))
        flat, owner, df = flat[sort], owner[sort], df[sort]
        once = np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])]
        flat, owner, df = flat[once], owner[once], df[once]
        k = np.bincount(owner, minlength=len(names))
        at = np.r_[0, np.cumsum(k)]
        sets, orders, widths, sketches = [], [], [], []
        able = np.flatnonzero(k * 100 >= n * percent)
        for i in able.tolist():
            hashes, times = flat[at[i] : at[i + 1]], df[at[i] : at[i + 1]]
            width = max(0, int(n[i]) - least_common(int(n[i]), percent) + 1 - (int(n[i]) - len(hashes)))
            sets.append(hashes.tobytes())
            sketches.append(sketch(hashes, n[i]))
            widths.append(width)
            orders.append(hashes[np.lexsort((hashes, times))][: width + DEPTH - 1].view(np.int64).tolist())
        return pa.table({"node": pa.array(names[able]), "n": pa.array(n[able]), "shared": pa.array(k[able]), "shingles": pa.array(sets, pa.binary()), "sketch": pa.array(sketches, pa.binary()), "order": pa.array(orders, pa.list_(pa.int64())), "width": pa.array(widths, pa.int32())})

    return shared.groupBy("block").applyInArrow(run, kind)


def sketch_bits(n) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, int(n) - 1).bit_length()))


def sketch(hashes: np.ndarray, n: int) -> bytes:
    """Parity of the number of hashes in each class; half as many classes are its halves, one laid over the other."""
    bits = sketch_bits(n)
    odd = np.bincount((hashes & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(node, pivot) with common (shingles in both) and the two sizes."""
    left = sets.select("node", F.col("n").alias("n1"), F.col("shingles").alias("s1"))
    right = sets.select(F.col("node").alias("pivot"), F.col("n").alias("n2"), F.col("shingles").alias("s2"))

    def run(batches):
        lean()
        for b in batches:
            common = [_common(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(common, pa.int64())], names=["node", "pivot", "n1", "n2", "common"])

    return pairs.join(left, "node").join(right, "pivot").select("node", "pivot", "n1", "n2", "s1", "s2").mapInArrow(run, "node bigint, pivot bigint, n1 bigint, n2 bigint, common bigint")


def close_pairs(node: np.ndarray, n: np.ndarray, shared: np.ndarray, sketches: list[bytes], component: np.ndarray, whole: bool, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of nodes of different components whose sizes and sketches allow a link: all of them if `whole`, else as many as would
    connect what all of them connect, those with the nearest sketches first."""
    order = np.lexsort((node, n))
    node, n, shared, component = node[order], n[order], shared[order], component[order]
    bits = np.array([sketch_bits(x) for x in n])
    rows = [np.frombuffer(sketches[i], dtype=np.uint64) for i in order]
    most = (100 - percent) * 1.0 / (100 + percent)
    found = []
    for level in np.unique(bits):
        mine = np.flatnonzero(bits == level)
        # sizes within the radius differ by one level at most
        near = np.flatnonzero((bits == level) | (bits == 2 * level))
        table = np.stack([rows[i] if bits[i] == level else rows[i][: level // 64] ^ rows[i][level // 64 :] for i in near])
        for x in mine.tolist():
            lo, hi = np.searchsorted(near, x + 1), np.searchsorted(n[near], n[x] * 100 // percent, side="right")
            them = near[lo:hi]
            if not len(them):
                continue
            apart = np.bitwise_count(table[lo:hi] ^ rows[x]).sum(1, dtype=np.int64)
            room = most * (n[x] + n[them]) + 1e-9 - (n[x] - shared[x]) - (n[them] - shared[them])
            ok = (apart <= room) & (component[them] != component[x])
            found += zip(apart[ok].tolist(), [x] * int(ok.sum()), them[ok].tolist(), strict=True)
    if whole:
        return [(int(node[x]), int(node[y])) for _, x, y in found]
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    out = []
    for _, x, y in sorted(found):
        a, b = find(int(component[x])), find(int(component[y]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(node[x]), int(node[y])))
    return out


def placed(members: DataFrame, sets: DataFrame, folder: str, name: str, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """members(region, node, at): the links with each region's document pivot (a, b), and the members that are to be joined again."""
    pivots = members.groupBy("region").agg(F.min("node").alias("pivot"), F.count("*").alias("c")).filter("c > 1").drop("c")
    inside = written(members.join(pivots, "region"), folder, f"inside{name}")
    pairs = inside.filter("node <> pivot").select("node", "pivot").distinct()
    known = written(measured(pairs, sets), folder, f"measured{name}")
    union = F.col("n1") + F.col("n2") - F.col("common")
    linked = F.col("common") * 100 >= union * percent
    radius = 1 - percent / 100
    far = known.select("node", "pivot", (1 - F.col("common") / union).alias("d"), linked.alias("ball"))
    where = inside.join(far, ["node", "pivot"], "left").select("region", "node", "at", F.coalesce("d", F.lit(0.0)).alias("d"), F.coalesce("ball", F.lit(True)).alias("ball"))
    where = written(where, folder, f"placed{name}")
    # of each region: is anything outside the ball, and how near to it
    rest = where.groupBy("region").agg(F.count_if(~F.col("ball")).alias("out"), F.min(F.when(~F.col("ball"), F.col("d"))).alias("nearest")).filter("out > 0")
    stay = ~F.col("ball") | ((F.col("nearest") <= 2 * radius + 1e-9) & (F.col("d") >= F.col("nearest") - radius - 1e-9))
    return known.filter(linked).select(F.col("node").alias("a"), F.col("pivot").alias("b")), where.join(rest, "region").filter(stay).select("region", "node", "at")


def links(sets: DataFrame, folder: str, percent: int = PERCENT, group: int = GROUP, depth: int = DEPTH) -> DataFrame:
    """a, b: links that connect every two nodes that links connect."""
    traits = sets.select("node", "n", "shared", "sketch")
    members = sets.select("node", F.posexplode(F.slice("order", F.lit(1), F.col("width"))).alias("at", "region"))
    found, small, level = None, [], 0
    while True:
        direct, again = placed(members, sets, folder, str(level), percent)
        direct = written(direct, folder, f"direct{level}")
        found = direct if found is None else found.unionByName(direct)
        again = written(unconnected(again, components(found, f"{folder}/cc{level}")), folder, f"again{level}")
        level += 1
        if level >= depth or again.filter(F.col("c") > group).isEmpty():
            small.append(again)
            break
        small.append(again.filter(F.col("c") <= group))
        # a pair that is linked has one more shingle in common within a window that is one wider
        deep = again.filter(F.col("c") > group).join(sets.select("node", "order", (F.col("width") + level).alias("width")), "node")
        members = deep.select("node", "region", "at", F.posexplode(F.slice("order", F.lit(1), F.col("width"))).alias("next", "hash")).filter("next > at").select("node", F.xxhash64("region", "hash").alias("region"), F.col("next").alias("at"))
        members = written(members, folder, f"members{level}")
    rest = small[0]
    for x in small[1:]:
        rest = rest.unionByName(x)

    def pairs_of(whole: bool):
        def run(key, t):
            lean()
            got = close_pairs(*(t.column(c).to_numpy() for c in ("node", "n", "shared")), t.column("sketch").to_pylist(), t.column("component").to_numpy(), whole, percent)
            return pa.table({"node": pa.array([x for x, _ in got], pa.int64()), "pivot": pa.array([x for _, x in got], pa.int64())})

        return run

    union = F.col("n1") + F.col("n2") - F.col("common")
    linked = F.col("common") * 100 >= union * percent
    for step in range(2):
        if step:
            rest = unconnected(rest.select("region", "node", "at"), components(found, f"{folder}/more"))
        units = written(split(rest, group), folder, f"units{step}")
        close = units.join(traits, "node").groupBy("region", "lo", "hi").applyInArrow(pairs_of(step > 0), "node bigint, pivot bigint").distinct()
        more = written(measured(close, sets).select(F.col("node").alias("a"), F.col("pivot").alias("b"), linked.alias("linked")), folder, f"more{step}")
        found = found.unionByName(more.filter("linked").drop("linked"))
        if more.filter("NOT linked").isEmpty():
            break
    return found


def unconnected(members: DataFrame, linked: DataFrame) -> DataFrame:
    """members(region, node, at) with each node's component and the region's number of members, c: regions whose nodes are in one
    component by now are out, and of regions with the same nodes that of the rarest shingle stays (which their first common one is)."""
    labelled = members.join(linked, "node", "left").select("region", "node", "at", F.coalesce("component", "node").alias("component"))
    kinds = labelled.groupBy("region").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("c"), F.sum("at").alias("at"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("mark")).filter("least <> most")
    kept = kinds.groupBy("c", "mark").agg(F.min(F.struct("at", "region"))["region"].alias("region")).select("region", "c")
    return labelled.join(kept, "region").select("region", "node", "at", "component", "c")


def split(members: DataFrame, group: int = GROUP) -> DataFrame:
    """members(region, node, component, c) -> region, lo, hi, node, component: the units to be joined. A region that is still large is cut in chunks, and each two of them (or one alone) make a unit."""
    mine = members.withColumn("chunks", F.greatest(F.ceil(F.col("c") * 2 / group), F.lit(1))).withColumn("i", F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")))
    unit = mine.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return unit.select("region", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "node", "component")


def classes(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of the documents; beside them key (a hash of the text) and part: the component's least node, null for an empty set."""
    spark = documents.sparkSession
    folder = shared_dir(spark)
    docs = docs_of(documents)
    size = text_bytes(docs)
    every = written(nodes_of(docs), folder, "rows")
    rows = every.filter("doc_id IS NOT NULL")
    hot = heavy(every.filter("doc_id IS NULL").select(F.col("node").alias("hash"), F.col("n_shingles").alias("n")), rows.count(), HEAVY / 2, HOTTEST)
    sets = written(candidates(shared_shingles(docs, hot, size), percent), folder, "sets")
    edges = written(links(sets, f"{folder}/join", percent), folder, "links")
    for name in ("join", "sets"):
        dropped(spark, f"{folder}/{name}")
    linked = components(edges, folder)
    first = rows.filter("node <> 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    # the least document of each component, for the nodes that have links; the others are their own
    least = linked.join(first, "node").groupBy("component").agg(F.min("least").alias("least"))
    named = linked.join(least, "component").select("node", "component", F.col("least").alias("by_links"))
    all_ = first.join(named, "node", "left").select("node", F.coalesce("by_links", "least").alias("component_id"), F.coalesce("component", "node").alias("part"))
    return rows.join(all_, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "key", "part")


def jaccard_join(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    return classes(documents, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, of which one of each component stays: the row with the least doc_id. Of rows that share this
    doc_id, the text with the least hash stays, of rows that share the text too the first by their other columns. A doc_id may come
    with several texts: each is judged by its own component. Texts without words link with nothing and stay, repeated rows once."""
    from pyspark.sql import Window

    found = written(classes(documents, percent), shared_dir(documents.sparkSession), "classes")
    best = found.filter("part IS NOT NULL").groupBy("part").agg(F.min(F.struct("doc_id", "key")).alias("row")).select("row.*")
    keep = best.unionByName(found.filter("part IS NULL").select("doc_id", "key")).distinct().select(F.col("doc_id").alias("_jaccard_id"), F.col("key").alias("_jaccard_key"))
    rows = documents.withColumn("_jaccard_text", F.xxhash64(F.col("text").cast("string")))
    got = rows.join(keep, (F.col("doc_id").cast("bigint") == F.col("_jaccard_id")) & (F.col("_jaccard_text") == F.col("_jaccard_key")), "left_semi")
    others = [F.col(f"`{c}`").cast("string") for c in documents.columns if c not in ("doc_id", "text")]
    once = Window.partitionBy("doc_id", "_jaccard_text").orderBy(*(others or [F.lit(1)]))
    return got.withColumn("_jaccard_nth", F.row_number().over(once)).filter("_jaccard_nth = 1").select(*documents.columns)


#: For DuckDB.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON m.x = d.doc_id
"""
