"""Pages and listings to raw rows."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import with_prefix, without_prefix
from ..functions.timeutil import parse_timestamp

SITE = "https://www.reddit.com"  # a fixed value: the site whose permalinks the records hold


def listing(pages: DataFrame, column: str = "value") -> DataFrame:
    """Posts of listing pages: page_no, pos and the fields of each t3 child, with an id."""
    child = "struct<kind: string, data: struct<id: string, name: string, subreddit: string, title: string, selftext: string, created_utc: double, score: long, permalink: string, author: string, is_self: boolean>>"
    got = pages.select("page_no", F.from_json(column, f"data struct<after: string, children: array<{child}>>").alias("p"))
    rows = got.select("page_no", "p.data.after", F.posexplode("p.data.children").alias("pos", "c")).filter("c.kind = 't3' AND c.data.id IS NOT NULL AND c.data.id <> ''")
    return rows.select("page_no", "pos", "after", "c.data.*")


def _walk(children: list, depth: int, post: str, out: list[dict], cut: list[int]) -> None:
    stack = [(c, depth) for c in reversed(children)]
    while stack:
        node, d = stack.pop()
        data = node.get("data") or {}
        if node.get("kind") == "more":
            cut[0] += int(data.get("count") or 0)
            continue
        if node.get("kind") != "t1" or not data.get("id"):
            continue
        own = data.get("depth")
        out.append({"post": post, "pos": len(out), "id": data["id"], "parent_id": data.get("parent_id"), "body": data.get("body"), "created_utc": float(data.get("created_utc") or 0), "depth": int(own if own is not None else d)})
        replies = data.get("replies")
        if isinstance(replies, dict):
            stack += [(c, d + 1) for c in reversed((replies.get("data") or {}).get("children") or [])]


def comment_tree(pages: DataFrame, column: str = "value") -> DataFrame:
    """Comments of nested reply trees, parents before replies; `more` nodes are counted, not emitted. Depth is unbounded, so no StructType fits; a page is walked with a stack of its own."""

    def flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[dict] = []
            for post, raw in zip(b["post"], b[column], strict=True):
                found: list[dict] = []
                cut = [0]
                try:
                    tree = json.loads(raw)
                except (TypeError, ValueError):
                    continue
                tree = tree[1] if isinstance(tree, list) and len(tree) > 1 else tree
                if isinstance(tree, dict):
                    _walk((tree.get("data") or {}).get("children") or [], 0, post, found, cut)
                rows += [r | {"more": cut[0]} for r in found]
            yield pd.DataFrame(rows, columns=["post", "pos", "id", "parent_id", "body", "created_utc", "depth", "more"])

    return pages.select("post", column).mapInPandas(flatten, "post string, pos int, id string, parent_id string, body string, created_utc double, depth int, more int")


class _Elements(HTMLParser):
    """Post and comment elements of a page, each with its attributes and the first body inside it that is its own."""

    KINDS = {"shreddit-post": "post", "shreddit-comment": "comment"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.done: list[dict] = []
        self.open: list[dict] = []
        self.divs = 0
        self.into: dict | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        found = {k.lower(): v or "" for k, v in attrs}
        if tag in self.KINDS:
            self.open.append({"kind": self.KINDS[tag], "attrs": found, "body": None, "pos": len(self.done) + len(self.open)})
        elif tag == "div":
            if self.into is not None:
                self.divs += 1
            elif found.get("id", "").endswith("-post-rtjson-content") and self.open:
                self.into, self.divs = {"owner": self.open[-1], "text": []}, 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "div" and self.into is not None:
            self.divs -= 1
            if not self.divs:
                owner = self.into["owner"]
                owner["body"] = owner["body"] or "".join(self.into["text"]).strip()
                self.into = None
        elif tag in self.KINDS and self.open and self.open[-1]["kind"] == self.KINDS[tag]:
            self.done.append(self.open.pop())

    def handle_data(self, data: str) -> None:
        if self.into is not None:
            self.into["text"].append(data)


def elements(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Key, kind, pos, attrs, body for each post and comment element; promoted posts are out."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, page in zip(b[key], b[html], strict=True):
                reader = _Elements()
                reader.feed(page or "")
                reader.close()
                for e in reader.done:
                    a = e["attrs"]
                    if e["kind"] == "post" and ("promoted" in a.get("class", "").lower() or a.get("ad-type") or "promoted" in a):
                        continue
                    rows.append((k, e["kind"], e["pos"], a, e["body"] or ""))
            yield pd.DataFrame(rows, columns=[key, "kind", "pos", "attrs", "body"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(parse, f"`{key}` {kind}, kind string, pos int, attrs map<string,string>, body string")


def flag(attrs: str, *names: str) -> Column:
    """Set if there with an empty or affirmative value."""
    return F.coalesce(*(F.lower(F.col(attrs)[n]).isin("", "true", "1", "yes") for n in names), F.lit(False)) if len(names) == 1 else F.array_contains(F.array(*(F.coalesce(F.lower(F.col(attrs)[n]).isin("", "true", "1", "yes"), F.lit(False)) for n in names)), True)


def whole(x: Column, default: int = 0) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")).try_cast("double").try_cast("long"), F.lit(default))


def real(x: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")).try_cast("double"), F.lit(default))


def first_of(*names: str, attrs: str = "attrs") -> Column:
    return F.coalesce(*(F.nullif(F.col(attrs)[n], F.lit("")) for n in names))


def posts(found: DataFrame) -> DataFrame:
    """Raw submissions from post elements; rows without an id or a time are out."""
    rows = found.filter("kind = 'post'").withColumn("name", with_prefix(F.coalesce(first_of("id"), F.lit("")), "t3_")).withColumn("created_utc", parse_timestamp(first_of("created-timestamp", "created")))
    short = without_prefix(F.col("name"), "t3_")
    link = F.coalesce(first_of("permalink"), F.concat(F.lit("/r/"), F.coalesce(F.col("attrs")["subreddit-name"], F.lit("")), F.lit("/comments/"), short, F.lit("/")))
    link = F.when(link.startswith("/"), link).otherwise(F.concat(F.lit("/"), link))
    return rows.filter("name <> '' AND created_utc IS NOT NULL").select(
        short.alias("id"), "name", without_prefix(F.coalesce(first_of("subreddit-name"), F.lit("")), "r/").alias("subreddit"), F.coalesce(first_of("post-title", "title"), F.lit("")).alias("title"), F.col("body").alias("selftext"), "created_utc",
        whole(F.col("attrs")["score"]).alias("score"), real(F.col("attrs")["upvote-ratio"]).alias("upvote_ratio"), whole(F.col("attrs")["comment-count"]).alias("num_comments"), link.alias("permalink"), F.coalesce(first_of("content-href"), F.concat(F.lit(SITE), link)).alias("url"),
        F.coalesce(F.lower(F.col("attrs")["post-type"]).isin("text", "self"), F.lit(False)).alias("is_self"), flag("attrs", "nsfw", "over-18", "over_18").alias("over_18"), flag("attrs", "stickied", "pinned", "is-stickied").alias("stickied"), whole(F.col("attrs")["award-count"]).alias("gilded"), F.col("attrs")["author"].alias("author"),
    )


def comments(found: DataFrame, fallback_subreddit: str = "") -> DataFrame:
    """Raw comments from comment elements; the parent defaults to the post."""
    name = with_prefix(F.coalesce(first_of("thingid", "thing-id", "id"), F.lit("")), "t1_")
    rows = found.filter("kind = 'comment'").filter(first_of("thingid", "thing-id").isNotNull() | F.coalesce(F.col("attrs")["id"].startswith("t1_"), F.lit(False))).withColumn("name", name).withColumn("created_utc", parse_timestamp(first_of("created", "created-timestamp")))
    link = F.coalesce(with_prefix(first_of("postid", "post-id"), "t3_"), F.concat(F.lit("t3_"), F.coalesce(F.col("attrs")["submission-id"], F.lit(""))))
    up = first_of("parentid", "parent-id")
    parent = F.when(up.isNull(), link).when(up.startswith("t1_") | up.startswith("t3_"), up).otherwise(F.concat(F.lit("t1_"), up))
    sub = without_prefix(F.coalesce(first_of("subredditname", "subreddit-name"), F.lit(fallback_subreddit)), "r/")
    short = without_prefix(F.col("name"), "t1_")
    path = F.coalesce(first_of("permalink"), F.concat(F.lit("/r/"), sub, F.lit("/comments/"), without_prefix(link, "t3_"), F.lit("/comment/"), short, F.lit("/")))
    return rows.filter("name <> '' AND created_utc IS NOT NULL").select(
        short.alias("id"), "name", link.alias("link_id"), parent.alias("parent_id"), sub.alias("subreddit"), "body", "created_utc", whole(F.col("attrs")["score"]).alias("score"), whole(F.col("attrs")["depth"]).cast("int").alias("depth"),
        flag("attrs", "is-op", "is-submitter").alias("is_submitter"), F.nullif(F.col("attrs")["distinguished"], F.lit("")).alias("distinguished"), flag("attrs", "stickied", "pinned", "is-stickied").alias("stickied"), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)).alias("permalink"), F.col("attrs")["author"].alias("author"),
    )


def id_of_permalink(x: Column) -> Column:
    """X17."""
    return F.nullif(F.regexp_extract(x, "/comments/([^/]+)", 1), F.lit(""))


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The native path of S09 for attribute-only queries: each link target of a page, by pattern, without a Python worker."""
    return pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1))).alias("pos", "href"))


def with_archive_defaults(raw: DataFrame) -> DataFrame:
    """What an archive row may lack. An empty or zero value counts as lacking where the contract's `or` does."""
    link = F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("id"), F.lit("/"))
    fixed = {"score": F.coalesce("score", F.lit(0)), "selftext": F.coalesce("selftext", F.lit("")), "upvote_ratio": F.coalesce("upvote_ratio", F.lit(1.0)), "permalink": F.coalesce(F.nullif("permalink", F.lit("")), link)}
    out = raw.withColumns({k: v for k, v in fixed.items() if k in raw.columns})
    return out.withColumn("url", F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit(SITE), F.col("permalink")))) if "url" in raw.columns else out


def listing_url(subreddit: Column, kind: Column, query: Column, sort: Column, span: Column, suffix: str = "/") -> Column:
    """The address of a listing: search (with a query), top of a span, or new, hot, rising; an unknown kind is new."""
    sub = without_prefix(F.regexp_replace(F.trim(subreddit), "^/+", ""), "r/")
    base = F.concat(F.lit(SITE + "/r/"), sub, F.lit("/"))
    span = F.coalesce(F.nullif(span, F.lit("")), F.lit("all"))
    search = F.concat(F.lit(f"search{suffix}?q="), F.url_encode(query), F.lit("&restrict_sr=1&sort="), F.coalesce(F.nullif(sort, F.lit("")), F.lit("relevance")), F.lit("&t="), span)
    plain = F.when(kind.isin("new", "hot", "rising"), kind).otherwise("new")
    return F.concat(base, F.when((kind == "search") & (F.coalesce(query, F.lit("")) != ""), search).when(kind == "top", F.concat(F.lit(f"top{suffix}?t="), span)).otherwise(F.concat(plain, F.lit(suffix))))


def comments_url(permalink: Column, sort: str = "confidence") -> Column:
    """X18."""
    url = F.when(permalink.rlike("^https?://"), permalink).otherwise(F.concat(F.lit(SITE), F.when(permalink.startswith("/"), F.lit("")).otherwise(F.lit("/")), permalink))
    return F.concat(url, F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?")), F.lit(f"sort={sort}"))
