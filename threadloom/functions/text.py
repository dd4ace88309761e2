"""Text expressions (X01-X09, X21, F02). White space and letters are Unicode-aware throughout: patterns carry (?U)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and word lists below must equal the data contract's.
TOKEN = r"[A-Za-zÀ-ÖØ-öø-ÿ'ñÑ]+"
URL = r"https?://\S+|www\.\S+"
MD_LINK = r"\[([^\]]*)\]\([^)]*\)"
MD_MARKUP = r"[*_~`>#|]+"
PLACEHOLDER_BODIES = ("[deleted]", "[removed]", "[deleted by user]")
ELONGATION = r"([a-zñ])\1{2,}"
PHATIC = (
    r"\b(?:happy\s+(?:belated\s+)?(?:birthday|bday|b-day)|hbd|maligayang\s+kaarawan"
    r"|congrat(?:s|ulations)?|thank\s*(?:s+|you|u|yo)|tysm|ty|salamat|maraming\s+salamat"
    r"|good\s+(?:morning|afternoon|evening|night|luck)|god\s*bless|ingat"
    r"|merry\s+christmas|happy\s+(?:new\s+year|holidays)|welcome(?!\s+to\b)"
    r"|condolences|get\s+well\s+soon|commenting\s+to\s+follow|following)\b"
)
PHATIC_FILLER = (
    "po poh op ate kuya sir maam ma'am guys everyone all sa mo ko you u ya so much very too din rin again ulit ha ah oh aw aww "
    "yay yey omg the a to and my your me us kayo ka day enjoy more many come blessings blessed best wishes cheers stay safe "
    "always nice work"
).split()
LAUGHTER = r"^(?:(?:ha|he|hi|hu|ah|eh)+h?|l+o+l+|lmao+|x+d+)$"
IRONY_GUARD = (
    "edi sana wow galing talaga daw raw kuno naman pala sure yeah right great totally ikaw lang nothing wala ever sarcasm"
).split()
SENTENCE_BREAK = r"(?U)(?<=[.!?…])\s+|\n+"
LETTER = r"[A-Za-zÀ-ÖØ-öø-ÿñÑ]"
SPAN_BREAK = r"(?U)(?:(?<=[.!?…])|(?<=[.!?…][\"'”’)\]]))\s+"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def strip(x: Column) -> Column:
    """Leading and trailing white space off, Unicode-aware."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def rstrip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+$", "")


def lstrip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+", "")


def ratio(x: Column, places: int = 4) -> Column:
    """A share of that many places as text without an exponent: 0.0006, where a cast says 6.0E-4."""
    return F.regexp_replace(x.cast(f"decimal({places + 6},{places})").cast("string"), f"0{{1,{places - 1}}}$", "")


def rounded(x: Column, places: int = 4) -> Column:
    """A share as SQL engines on doubles round it: scaled first, so 577/800 is 0.7212, where F.round goes by the digits of 0.72125."""
    return F.round(x * 10.0**places) / 10.0**places


def normalize(x: Column) -> Column:
    """Link text kept, URLs and markup to blanks, blanks squeezed; in this order."""
    x = F.regexp_replace(F.coalesce(x, F.lit("")), MD_LINK, "$1")
    x = F.regexp_replace(x, "(?U)" + URL, " ")
    x = F.regexp_replace(x, MD_MARKUP, " ")
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def tokens(x: Column) -> Column:
    """X02."""
    return F.regexp_extract_all(x, F.lit(TOKEN), F.lit(0))


def collapse(x: Column) -> Column:
    """Three or more of one letter become one."""
    return F.regexp_replace(x, ELONGATION, "$1")


def is_phatic(norm: Column, max_tokens: int = 10, max_leftover: int = 2) -> Column:
    """a short social ritual with nothing else in it; any sign of irony vetoes it."""
    text = collapse(F.lower(norm))
    words = tokens(text)
    left = F.filter(tokens(F.regexp_replace(text, "(?iU)" + PHATIC, " ")), lambda t: ~t.isin(*PHATIC_FILLER) & ~t.rlike(LAUGHTER))
    guard = F.arrays_overlap(words, F.array(*map(F.lit, IRONY_GUARD)))
    return (F.size(words) > 0) & (F.size(words) <= max_tokens) & ~guard & text.rlike("(?iU)" + PHATIC) & (F.size(left) <= max_leftover)


def sentence_count(x: Column) -> Column:
    """Pieces with a letter, by closing marks and line breaks."""
    return F.size(F.filter(F.split(F.coalesce(x, F.lit("")), SENTENCE_BREAK), lambda p: p.rlike(LETTER)))


def length_band(x: Column) -> Column:
    """X05."""
    n = sentence_count(x)
    return F.when(n <= 3, "short").when(n <= 5, "medium").otherwise("long")


def split_sentences(x: Column) -> Column:
    """Each line's pieces, stripped, without empty ones."""
    pieces = F.flatten(F.transform(F.split(x, LINE_BREAK), lambda line: F.split(line, SPAN_BREAK)))
    return F.filter(F.transform(pieces, strip), lambda p: p != "")


def join_ticked(sarcastic: Column, sentences: Column, ticked: Column) -> Column:
    """The ticked sentences, one a line; NULL unless sarcastic."""
    both = F.filter(F.zip_with(sentences, ticked, lambda s, t: F.when(t, s)), lambda s: s.isNotNull())
    return F.when(sarcastic & (F.size(both) > 0), F.array_join(both, "\n"))


def truncate(x: Column, limit: int) -> Column:
    """At most `limit` characters, the last one an ellipsis if any were cut."""
    x = strip(x)
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(rstrip(F.substring(x, 1, limit - 1)), F.lit("…")))


def truncate_middle(x: Column, head: int = 1200, tail: int = 300) -> Column:
    x = strip(x)
    return F.when(F.length(x) <= head + tail, x).otherwise(F.concat(rstrip(F.substring(x, 1, head)), F.lit("\n[…]\n"), lstrip(F.right(x, F.lit(tail)))))


def display(x: Column, limit: int = 160) -> Column:
    """P09."""
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit), F.lit("…"))).otherwise(x)


def escape_html(x: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(raw), F.lit(safe))
    return x


def merged_intervals(spans: Column) -> Column:
    """array<struct<lo, hi>> -> the same, sorted, with overlapping or touching ones merged."""
    empty = F.filter(F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi"))), lambda x: F.lit(False))

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (x["lo"] <= last["hi"])
        grown = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"))))
        return F.when(joins, grown).otherwise(F.concat(acc, F.array(F.struct(x["lo"].alias("lo"), x["hi"].alias("hi")))))

    return F.aggregate(F.array_sort(spans), empty, step)


def highlight(text: Column, span: Column) -> tuple[Column, Column]:
    """Escaped HTML with the span's lines marked, and the lines that the text doesn't hold."""
    parts = F.filter(F.split(F.coalesce(span, F.lit("")), "\n"), lambda p: strip(p) != "")
    found = F.filter(parts, lambda p: F.position(p, text) > 0)
    missing = F.filter(parts, lambda p: F.position(p, text) == 0)
    spans = F.transform(found, lambda p: F.struct((F.position(p, text) - 1).cast("int").alias("lo"), (F.position(p, text) - 1 + F.length(p)).cast("int").alias("hi")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"))

    def step(acc: Column, x: Column) -> Column:
        plain = escape_html(F.substring(text, acc["pos"] + 1, x["lo"] - acc["pos"]))
        marked = escape_html(F.substring(text, x["lo"] + 1, x["hi"] - x["lo"]))
        return F.struct(F.concat(acc["out"], plain, F.lit("<mark>"), marked, F.lit("</mark>")).alias("out"), x["hi"].alias("pos"))

    html = F.aggregate(merged_intervals(spans), start, step, lambda acc: F.concat(acc["out"], escape_html(F.substring(text, acc["pos"] + 1, F.length(text)))))
    return F.replace(html, F.lit("\n"), F.lit("<br>")), missing


def json_object(x: Column) -> Column:
    """The outermost {...} of a model's answer, its <think> part left out."""
    return F.nullif(F.regexp_extract(F.regexp_replace(x, r"(?s)<think>.*?</think>", ""), r"(?s)\{.*\}", 0), F.lit(""))
