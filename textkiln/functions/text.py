"""Text kernel as built-in expressions: tokens, normalised bodies, digests, structure, slugs, dates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What doesn't count as a token's text.
FENCE = r"(?s)```.*?```"
URL = r"https?://\S+"


def folded(text: Column) -> Column:
    """Lower case, with the three letters that case folding changes further."""
    return F.translate(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), "ςſ", "σs")


def folded_sql(text: str) -> str:
    return f"replace(replace(replace(lower({text}), 'ß', 'ss'), 'ς', 'σ'), 'ſ', 's')"


def tokens(text: Column) -> Column:
    """Fences and URLs go, case is folded, letters and digits only, longer than two characters."""
    bare = F.regexp_replace(folded(F.regexp_replace(F.coalesce(text, F.lit("")), FENCE, " ")), URL, " ")
    return F.filter(F.split(bare, r"[^\p{L}\p{N}]+"), lambda t: F.length(t) > 2)


def tokens_sql(text: str) -> str:
    """The same for DuckDB, over an expression."""
    fenceless = f"regexp_replace(coalesce({text}, ''), '(?s)```.*?```', ' ', 'g')"
    bare = f"regexp_replace({folded_sql(fenceless)}, 'https?://\\S+', ' ', 'g')"
    return f"list_filter(regexp_split_to_array({bare}, '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 2)"


def search_words(text: Column) -> Column:
    """Words of the retrieval index."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9_]+"), F.lit(0))


#: The characters at which a line ends (CR LF counts once), and all that counts as blank.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _class(characters: str) -> str:
    """A character class in the escapes that Java and RE2 share."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in characters) + "]"


#: Between two blocks of a text: a line that holds blanks at most.
BLANK_LINE = rf"\n{_class(BLANKS)}*\n"
_BLANK, _INNER = _class(BLANKS), _class(BLANKS.replace("\n", ""))


def _where(text: Column, asked: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``change`` of texts for which ``asked`` holds; the text is evaluated once, however often both name it."""
    return F.get(F.transform(F.array(text), lambda x: F.when(asked(x), change(x)).otherwise(x)), F.lit(0))


def normalize_body(text: Column) -> Column:
    """LF line ends, no blanks at line ends, at most one empty line between, stripped, one final LF.

    Lines and the whole are trimmed from their ends: a pattern would be tried at every character. A pattern runs only over texts that
    hold what it looks for, which a search for the characters tells at far less cost.
    """
    odd = lambda x: reduce(Column.__or__, [F.contains(x, F.lit(c)) for c in LINE_ENDS[1:]])
    t = _where(F.coalesce(text, F.lit("")), odd, lambda x: F.regexp_replace(x, f"\r\n|{_class(LINE_ENDS)}", "\n"))
    t = F.array_join(F.transform(F.split(t, "\n"), lambda x: F.rtrim(x, F.lit(BLANKS))), "\n")
    t = _where(t, lambda x: F.contains(x, F.lit("\n\n\n")), lambda x: F.regexp_replace(x, "\n{3,}", "\n\n"))
    return F.concat(F.btrim(t, F.lit(BLANKS)), F.lit("\n"))


def normalize_body_sql(text: str) -> str:
    """The same for DuckDB, over an expression."""
    t = f"regexp_replace(coalesce({text}, ''), '\\r\\n|{_class(LINE_ENDS)}', chr(10), 'g')"
    t = f"regexp_replace({t}, '{_INNER}+(\\n|$)', '\\1', 'g')"
    return f"regexp_replace(regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g') || chr(10)"


def body_hash(text: Column) -> Column:
    return F.sha2(normalize_body(text), 256)


def estimated_tokens(text: Column) -> Column:
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


#: What a line of each structure looks like, how many of its lines make one, and what is counted anywhere.
LINE_STRUCTURES = {
    "headings": (r"^#{1,6}\s+", 1),
    "lists": (r"^\s*(?:[-*+] |\d+\. )", 1),
    "tables": (r"^\s*\|?.+\|.+\|?\s*$", 2),
    "code_blocks": (r"^```", 2),
    "callouts": (r"^>", 1),
}
INLINE_STRUCTURES = {
    "figures": r"!\[[^\]]*\]\([^)]+\)",
    "links": r"(?<!!)\[[^\]]+\]\([^)]+\)",
    "assets": r"!\[[^\]]*\]\((?!https?://)[^)]+\)",
}


def structure(body: Column) -> dict[str, Column]:
    """Counts of headings, lists, tables, code blocks, callouts, figures, links and local assets."""
    lines = F.split(body, "\n")

    def like(pattern: str) -> Column:
        return F.size(F.filter(lines, lambda x: x.rlike(pattern)))

    by_line = {k: F.floor(like(p) / n).cast("long") for k, (p, n) in LINE_STRUCTURES.items()}
    return by_line | {k: F.regexp_count(body, F.lit(p)).cast("long") for k, p in INLINE_STRUCTURES.items()}


def heading_titles(body: Column) -> Column:
    """Distinct titles of heading lines, blanks made one and case folded."""
    raw = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"(?m)^#{1,6}[^\S\n]+(\S.*?)\s*$"), F.lit(1))
    return F.array_distinct(F.transform(raw, lambda t: folded(F.regexp_replace(t, r"\s+", " "))))


def heading_slug(title: Column) -> Column:
    """Anchor of a heading: lower case, word characters, blanks to hyphens."""
    return F.replace(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}_\- ]", ""), F.lit(" "), F.lit("-"))


def identity(value: Column) -> Column:
    return F.translate(F.lower(value), "_.", "--")


def sorted_tags(tags: Column) -> Column:
    """Trimmed, non-empty, distinct, sorted without regard to case (then by themselves)."""
    clean = F.array_distinct(F.filter(F.transform(tags, lambda t: F.trim(t)), lambda t: t != ""))
    return F.transform(F.array_sort(F.transform(clean, lambda t: F.struct(F.lower(t).alias("k"), t.alias("t")))), lambda x: x["t"])


#: Month names of long dates.
MONTHS = "January February March April May June July August September October November December".split()


def long_date(text: Column) -> Column:
    """ISO date of the first ``Month d, yyyy`` (long or three-letter month), or null."""
    found = F.regexp_extract(text, r"\b([A-Z][a-z]{2,8}) (\d{1,2}), (\d{4})\b", 0)
    number = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(found, 1, 3))
    whole = F.regexp_extract(found, r"^([A-Z][a-z]+)", 1)
    known = F.array_contains(F.array(*[F.lit(m) for m in MONTHS], *[F.lit(m[:3]) for m in MONTHS]), whole)
    iso = F.concat_ws("-", F.regexp_extract(found, r"(\d{4})$", 1), F.lpad(number.cast("string"), 2, "0"), F.lpad(F.regexp_extract(found, r" (\d{1,2}),", 1), 2, "0"))
    return F.when(known & (number > 0), F.try_to_date(iso, "yyyy-MM-dd").cast("string"))


def source_date(value: Column) -> Column:
    """ISO date of an ISO date or time, an RFC 2822 date, or null."""
    v = F.trim(value)
    rfc = F.regexp_extract(v, r"^(?:[A-Z][a-z]{2}, )?(\d{1,2}) ([A-Z][a-z]{2}) (\d{4})", 0)
    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.regexp_extract(v, r"(\d{1,2}) ([A-Z][a-z]{2}) (\d{4})", 2))
    iso = F.concat_ws("-", F.regexp_extract(v, r"([A-Z][a-z]{2}) (\d{4})", 2), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(v, r"(\d{1,2}) [A-Z][a-z]{2} \d{4}", 1), 2, "0"))
    head = F.substring(v, 1, 10)
    return F.coalesce(
        F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(head, "yyyy-MM-dd")),
        F.when((rfc != "") & (month > 0), F.try_to_date(iso, "yyyy-MM-dd"))).cast("string")


def aware_time(value: Column) -> Column:
    """Timestamp of an ISO time that names its zone; null without a zone."""
    zoned = value.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, F.try_to_timestamp(value))
