"""Author history (W09, W10, A23, J14) by range frames over microseconds, and caps by rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOWS = (48, 7 * 24, 30 * 24, None)
CAP = 5
HOUR = 3_600_000_000
#: An author's rows of thirty days are counted in one task.
SPAN = 30 * 24 * HOUR


def _before(hours: int | None, by: list[str], micros: str):
    lower = Window.unboundedPreceding if hours is None else -hours * HOUR
    return Window.partitionBy(*by).orderBy(micros).rangeBetween(lower, -1)


def history_counts(events: DataFrame, author: str = "author", micros: str = "us", windows: tuple = WINDOWS, cap: int = CAP, span: int = SPAN) -> DataFrame:
    """For each row and window the same author's rows strictly before it (equal times excluded), capped. One sort serves all windows. Rows without author or time have 0.

    An author's rows are counted span by span, so a prolific author is many tasks: as counts stop at the cap, all that a span needs of
    the time before it are the author's last `cap` rows, which come from as many earlier spans that have rows at most.
    """
    known = F.col(author).isNotNull() & F.col(micros).isNotNull()
    # rows without an author get one each, else they would all meet in one task
    own = F.when(known, F.col(author).cast("string")).otherwise(F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string")))
    df = events.withColumn("_a", own).withColumn("_s", F.floor(F.col(micros) / span)).withColumn("_own", F.lit(True))
    spans = first_k(events.filter(known).select(F.col(author).cast("string").alias("_a"), F.floor(F.col(micros) / span).alias("_s"), micros), ["_a", "_s"], [F.desc(micros)], cap).groupBy("_a", "_s").agg(F.collect_list(micros).alias("_last"))
    back = Window.partitionBy("_a").orderBy("_s").rowsBetween(-cap, -1)  # of an author's spans, not rows
    late = F.slice(F.sort_array(F.flatten(F.collect_list("_last").over(back)), asc=False), 1, cap)
    carried = spans.select("_a", "_s", late.alias("_t")).select("_a", "_s", F.explode("_t").alias(micros), F.lit(False).alias("_own"))
    both = df.unionByName(carried, allowMissingColumns=True)
    is_known = ~F.col("_a").startswith("\0")
    counted = both.withColumns({f"n_{'all' if h is None else h}": F.when(is_known, F.least(F.lit(cap), F.count(F.lit(1)).over(_before(h, ["_a", "_s"], micros)))).otherwise(0).cast("int") for h in windows})
    return counted.filter("_own").drop("_a", "_s", "_own")


def coverage(counted: DataFrame, windows: tuple = WINDOWS, cap: int = CAP) -> DataFrame:
    """Window, n_rows, shares with at least 1, 3 and the cap, mean; counted holds the target rows (count over the corpus first, then filter)."""
    stacked = counted.select(F.explode(F.array(*(F.struct(F.lit("unbounded" if h is None else f"{h // 24}d" if h % 24 == 0 and h != 48 else f"{h}h").alias("window"), F.col(f"n_{'all' if h is None else h}").alias("c")) for h in windows))).alias("x")).select("x.*")
    share = lambda k: F.round(F.avg((F.col("c") >= k).cast("int")), 4)
    return stacked.groupBy("window").agg(F.count("*").alias("n_rows"), share(1).alias("at_least_1"), share(3).alias("at_least_3"), share(cap).alias("full"), F.round(F.avg("c"), 3).alias("mean_available"))


def last_posts(events: DataFrame, hours: int = 48, k: int = CAP, author: str = "author", micros: str = "us", item: str = "item_id", span: int = SPAN) -> DataFrame:
    """Each row with `history`, the last k items of its author strictly before it within the window, oldest first; of equal times the
    larger ids are the later ones. Rows of the row's own time are no history and take no place of it. Rows without author or time have none.

    What a row sees is the same for all rows of one author and time, so times are ranked, not rows: each distinct time carries its last k
    items, and k times back hold whatever can be among the last k. As in history_counts, an author's times are worked through span by
    span, each with the last k items of earlier spans, so a prolific author is many tasks.
    """
    known = F.col(author).isNotNull() & F.col(micros).isNotNull()
    spot = F.struct(F.col(micros).alias("us"), F.col(item).alias("item"))
    rows = events.filter(known).select(F.col(author).alias("_a"), F.floor(F.col(micros) / span).alias("_s"), F.col(micros).alias("_u"), spot.alias("_x"))
    last = lambda by: first_k(rows, by, [F.desc("_x")], k).groupBy(*by)
    times = last(["_a", "_s", "_u"]).agg(F.collect_list("_x").alias("_here"))
    spans = last(["_a", "_s"]).agg(F.collect_list("_x").alias("_last"))
    newest = lambda xs: F.slice(F.sort_array(xs, asc=False), 1, k)
    earlier = newest(F.flatten(F.collect_list("_last").over(Window.partitionBy("_a").orderBy("_s").rowsBetween(-k, -1))))
    carried = spans.select("_a", "_s", earlier.alias("_before"))
    back = F.flatten(F.collect_list("_here").over(Window.partitionBy("_a", "_s").orderBy("_u").rowsBetween(-k, -1)))
    seen = times.select("_a", "_s", "_u", back.alias("_back")).join(carried, ["_a", "_s"])
    near = F.filter(newest(F.concat("_back", "_before")), lambda x: x["us"] >= F.col("_u") - hours * HOUR)
    found = seen.select("_a", "_u", F.transform(F.sort_array(near), lambda x: x["item"]).alias("history"))
    mine = events.filter(known).join(found, (F.col(author) == F.col("_a")) & (F.col(micros) == F.col("_u"))).drop("_a", "_u")
    alone = events.filter(~known).withColumn("history", F.array().cast(mine.schema["history"].dataType))
    return mine.unionByName(alone)


def first_k(rows: DataFrame, by: list[str], order: list[Column | str], k: int) -> DataFrame:
    """The first k rows of each group; order must settle ties. Spark cuts each task's groups before the shuffle."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_k") <= k).drop("_k")


def daily_sample(rows: DataFrame, group: list[str], item: str, k: int) -> DataFrame:
    """K rows of each group (a feed and day) by the hash of their ids: the same rows on every run."""
    return first_k(rows, group, [F.sha2(F.col(item).cast("string"), 256), F.col(item)], k)


def calendar_action(ts: Column, start: Column, end: Column, taken: Column, cap: int) -> Column:
    """F20."""
    return F.when(ts < start, "stop").when(ts >= end, "skip_newer").when(taken >= cap, "skip_full").otherwise("take")


def in_day(ts: Column, start: Column, end: Column) -> Column:
    """half-open; a row without a time passes, as the listing check lets it."""
    return ts.isNull() | ((ts >= start) & (ts < end))


def kept_comments(comments: DataFrame, max_depth: int, cap: int, placeholders: tuple[str, ...] = ("[deleted]", "[removed]")) -> DataFrame:
    """F10 then W06: depth and placeholder filters first, the cap counts what is kept."""
    kept = comments.filter((F.col("depth") <= max_depth) & ~F.col("body").isin(*placeholders))
    return first_k(kept, ["submission_item"], ["created_s", "item_id"], cap)
