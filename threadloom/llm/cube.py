"""Operator 4: mixing sources to target weights by cube-method balanced sampling.

Each document of a source is taken floor(r) times, r = target / size of the source, and once more for a sample in which every
document has inclusion probability r - floor(r). The sample is balanced: the flight phase moves the probabilities inside the
null space of the constraints (documents and words taken) until all but a few are 0 or 1. It runs in blocks of a source's
documents; what is still fractional goes on to the next level's blocks, until one block per source is left, whose last few
documents, with REOPENED decided ones that may change sides, make the landing problem: of all outcomes the nearest to the totals.
Where one large document leaves the words far off, more decided ones change sides.

Cases: a null or empty text has size 0 (its document may be taken, with 0 words); a null source is a source of its own, last;
a repeated row is a document of its own; rows with a null doc_id are left out; with no words at all every target is 0; ties in size
go by place; a very long text counts by its words like any other and no text travels; other columns, whatever their names, are not
looked at; an empty table gives an empty result.
Draws come from hashes of the block's documents, so reruns agree.
"""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, docs_of, shared_dir, written

WEIGHTS = (1, 2, 3)
CAP = 3
#: Documents of a block; sources whose table is broadcast at most (each below BROADCAST_BYTES of names in all).
BLOCK = 2048
#: Decided documents that the landing tries both ways at a time.
REOPENED = 12
BROADCAST_SOURCES = 100_000
BROADCAST_BYTES = 16 << 20
EPS = 1e-9


def _step(p: list[float], a: list[tuple[float, float]], draw: random.Random) -> None:
    """Move three probabilities along the null vector of their two constraints until one is 0 or 1."""
    (x0, y0), (x1, y1), (x2, y2) = a
    u = [x1 * y2 - x2 * y1, x2 * y0 - x0 * y2, x0 * y1 - x1 * y0]
    if max(map(abs, u)) < EPS:  # the constraints say the same of these three: two of them trade
        u = [x1, -x0, 0.0]
        if max(map(abs, u)) < EPS:
            u = [1.0, -1.0, 0.0]
    up = min((1 - q) / v if v > 0 else -q / v for q, v in zip(p, u, strict=True) if v)
    down = min(q / v if v > 0 else (q - 1) / v for q, v in zip(p, u, strict=True) if v)
    t = up if draw.random() * (up + down) < down else -down
    for i in range(3):
        q = p[i] + t * u[i]
        p[i] = 0.0 if q < EPS else 1.0 if q > 1 - EPS else q


def flight(pi: list[float], size: list[float], draw: random.Random) -> list[float]:
    """Probabilities after the flight phase; at most two of them are still fractional."""
    pi = list(pi)
    live: list[int] = []
    for i in range(len(pi)):
        if not 0 < pi[i] < 1:
            continue
        live.append(i)
        if len(live) == 3:
            p = [pi[k] for k in live]
            _step(p, [(1.0, size[k]) for k in live], draw)
            for k, q in zip(live, p, strict=True):
                pi[k] = q
            live = [k for k in live if 0 < pi[k] < 1]
    return pi


def _nearest(pi: list[float], size: list[float], open_: list[int], wanted: tuple[float, float]) -> None:
    """Decide the open documents all at once: of all outcomes the one nearest to the wanted words, then to the wanted number, then with fewest changes."""
    if not open_:
        return
    outcome = np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1
    sizes, old = np.array([size[i] for i in open_]), np.array([pi[i] for i in open_])
    rest = [sum(w * (1.0 if by is None else by[i]) for i, w in enumerate(pi) if i not in set(open_)) for by in (size, None)]
    words, count = np.abs(outcome @ sizes + rest[0] - wanted[0]), np.abs(outcome.sum(1) + rest[1] - wanted[1])
    best = outcome[np.lexsort((np.abs(outcome - old).sum(1), count, np.round(words, 6)))[0]]
    for i, bit in zip(open_, best, strict=True):
        pi[i] = float(bit)


def landing(pi: list[float], size: list[float], wanted: tuple[float, float]) -> list[float]:
    """The last fractional documents, decided all at once together with a few decided ones, evenly spread over the sizes, that
    may change sides. If the words are still off by more than a middling document, decided ones of the wrong side change it,
    the largest that fit first, and the last difference is settled like the first."""
    pi = list(pi)
    fractional = [i for i, p in enumerate(pi) if 0 < p < 1]
    settled = sorted((i for i, p in enumerate(pi) if p in (0.0, 1.0) and size[i] > 0), key=lambda i: (size[i], i))

    def spread() -> list[int]:
        n = min(REOPENED, len(settled))
        return [settled[(2 * k + 1) * len(settled) // (2 * n)] for k in range(n)]

    if not fractional:
        return pi
    _nearest(pi, size, fractional + spread(), wanted)
    short = wanted[0] - sum(p * x for p, x in zip(pi, size, strict=True))
    if settled and abs(short) > size[settled[len(settled) // 2]]:
        for i in reversed(settled):
            if size[i] <= abs(short) and pi[i] == (0.0 if short > 0 else 1.0):
                short += -size[i] if short > 0 else size[i]
                pi[i] = 1 - pi[i]
        _nearest(pi, size, spread(), wanted)
    return pi


def sizes(documents: DataFrame, *more: str) -> DataFrame:
    return docs_of(documents, "source").select("doc_id", "source", F.xxhash64("text").alias("text_key"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, folder: str) -> DataFrame:
    """source, source_size, target, n_docs. Ranks come from ranges of the source names, and the level of the shares from a few sums over the table, so nothing is gathered."""
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), folder, "totals")
    ranged = written(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), folder, "ranged")
    before, at = 0, {}
    for part, n in sorted(map(tuple, ranged.groupBy("part").count().collect())):  # as many rows as partitions
        at[part], before = before, before + n
    if not at:
        return totals.withColumn("target", F.lit(0.0))
    base = F.create_map(*(F.lit(x) for kv in at.items() for x in kv))[F.col("part")]
    rank = base + F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = ranged.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS)).cast("int") + 1)).drop("part")
    ranked = written(ranked, folder, "ranked")
    # a target is min(CAP * size, level * weight); the level rises as sources reach their caps
    level, capped = 0.0, -1
    while True:
        full = F.col("source_size") * CAP <= F.lit(level) * F.col("weight")
        total, held, free, n = ranked.agg(F.sum("source_size"), F.sum(F.when(full, F.col("source_size") * CAP).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count_if(full)).first()
        if n == capped or not free:
            break
        capped, level = n, (total - held) / free
    target = F.least(F.col("source_size") * CAP * F.lit(1.0), F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


def with_targets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    n, names = targets.agg(F.count("*"), F.sum(F.coalesce(F.octet_length("source"), F.lit(0)))).first()
    side = targets.withColumnRenamed("source", "of")
    if n <= BROADCAST_SOURCES and (names or 0) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return sized.join(side, sized["source"].eqNullSafe(side["of"])).drop("of")


def _draw(*of: object) -> random.Random:
    return random.Random(hashlib.sha256(repr(of).encode()).digest())


def sample(units: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """units(unit columns..., source, n_docs, pi, size) -> the same with pi 0 or 1, level by level.

    A source's blocks number n_docs / block at the first level; each leaves two documents at most, so the levels are few.
    """
    keys = ["source", "level_blocks", "block"]
    kind = "doc_id long, text_key long, copy int, source string, size long, pi double, n_docs long"
    names = [x.split()[0] for x in kind.split(", ")]

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text_key", "copy"], kind="stable").reset_index(drop=True)
        name = pdf["source"].iloc[0]
        blocks = int(pdf["level_blocks"].iloc[0])
        draw = _draw(None if pd.isna(name) else name, blocks, int(pdf["block"].iloc[0]))
        pi, size = pdf["pi"].tolist(), pdf["size"].astype(float).tolist()
        # the largest first, so that those left fractional are small
        order = sorted(range(len(pi)), key=lambda i: (-size[i], i))
        moved = flight([pi[i] for i in order], [size[i] for i in order], draw)
        if blocks == 1:
            moved = landing(moved, [size[i] for i in order], (sum(p * x for p, x in zip(pi, size, strict=True)), sum(pi)))
        for i, p in zip(order, moved, strict=True):
            pi[i] = p
        return pdf.assign(pi=pi)[names]

    settled, rest, level = [], units, 0
    most = int(units.agg(F.max("n_docs")).first()[0] or 0)
    blocks = max(1, -(-most // block))
    while True:
        level_blocks = F.greatest(F.ceil(F.col("n_docs") / block), F.lit(1)) if level == 0 else F.greatest(F.ceil(F.col("n_docs") * 2 ** level / block ** (level + 1)), F.lit(1))
        dealt = rest.select(*names).withColumn("level_blocks", level_blocks.cast("long")).withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key", "copy", F.lit(level)), F.col("level_blocks")))
        done = written(dealt.groupBy(*keys).applyInPandas(fly, kind), folder, f"level{level}")
        settled.append(done.filter("pi = 0 OR pi = 1"))
        rest = done.filter("pi > 0 AND pi < 1")
        if blocks == 1:
            break
        level += 1
        blocks = max(1, -(-most * 2**level // block ** (level + 1)))
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, text_key: copies = times the mix takes the document."""
    folder = shared_dir(documents.sparkSession)
    sized = written(sizes(documents), folder, "sizes")
    full = with_targets(sized, source_targets(sized, folder))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + EPS)
    part = F.greatest(ratio - whole, F.lit(0.0))
    same = Window.partitionBy("doc_id", "text_key", "source").orderBy("size")
    full = full.withColumn("whole", whole).withColumn("pi", F.when(part < EPS, 0.0).otherwise(part)).withColumn("copy", F.row_number().over(same))
    units = full.select("doc_id", "text_key", "copy", "source", "size", "pi", "n_docs")
    chosen = sample(units, folder).select("doc_id", "text_key", "copy", F.col("source").alias("of"), F.col("pi").cast("long").alias("extra"))
    on = (full["doc_id"] == chosen["doc_id"]) & (full["text_key"] == chosen["text_key"]) & (full["copy"] == chosen["copy"]) & full["source"].eqNullSafe(chosen["of"])
    return full.join(chosen, on).select(
        full["doc_id"], "size", "source_size", "target", ((F.col("whole") + F.col("extra")) * F.col("size")).cast("long").alias("taken"), (F.col("whole") + F.col("extra")).cast("long").alias("copies"), full["text_key"], full["source"]
    )


def mixed_sizes(documents: DataFrame) -> DataFrame:
    return mix(documents).drop("text_key", "source")
