"""Private data: which kinds a text holds, where, and consistent replacement.

Kinds are decided by built-in regular expressions in one projection. Offsets and replacement run in
Arrow batches over the rows that have a kind at all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind and pattern; patterns stay within what Java, RE2 and Python agree on.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ipv4": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\b",
    "phone": r"\+[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3}-[0-9]{4}",
    "card": r"\b[0-9]{16}\b",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "credential": r"(?i)\b(?:password|passwd|api[_-]?key|secret|token)\b[ ]*[:=]",
}
#: Addresses reserved for documentation, which are not private.
PLACEHOLDERS = r"^(?:192\.0\.2\.|198\.51\.100\.|203\.0\.113\.|0\.0\.0\.0$|127\.0\.0\.1$)|@example\.(?:com|org|net)$"


#: What every match of a kind holds; texts without it aren't searched.
NEEDS = {"email": ("@",), "phone": ("+",), "private_key": ("-----BEGIN",), "credential": (":", "=")}


def kinds(text: Column) -> Column:
    """Sorted kinds that the text holds."""
    t = F.coalesce(text, F.lit(""))

    def holds(kind: str, pattern: str) -> Column:
        may = reduce(Column.__or__, [t.contains(x) for x in NEEDS.get(kind, ())], F.lit(kind not in NEEDS))
        return F.when(may, F.when(t.rlike(pattern), F.lit(kind)))

    return F.array_sort(F.array_compact(F.array(*[holds(k, p) for k, p in KINDS.items()])))


#: Kinds of private data that a page is searched for, and their patterns, without regard to case. Whose consoles a tenant's
#: host is below depends on the corpus; another table of patterns can be given.
PAGE_KINDS = {
    "authorization-header": r"""Authorization[\s"':]+(?:Bearer|APIToken)\s+[A-Za-z0-9+/=_-]{16,}""",
    "cloud-account": r"\b\d{12}\b",
    "credential": r"""\b(?:api[_-]?key|password|secret|token)["']?\s*[:=]\s*["']?[A-Za-z0-9+./=_-]{16,}""",
    "email": r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "ipv4": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "private-key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "resource-id": r"\b(?:vpc|subnet|rtb|i|sg)-[a-f0-9]{8,}\b",
    "session-cookie": r"""(?:\b(?:Set-Cookie|Cookie)\s*:|--cookie(?:\s+|=))[^\r\n<>]*?\b[A-Za-z0-9_-]+\s*=\s*["']?[A-Za-z0-9+/=_-]{16,}""",
    "tenant-host": r"https://(?!example-corp\.)[a-z0-9-]+\.console\.example\.(?:net|org)",
    "uuid": r"\b[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}\b",
}
#: What a reader doesn't see of a page, attributes that say something all the same, and characters written as entities.
UNSEEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
SAYING = r"""(?is)\s(?:alt|title|href|src)\s*=\s*("[^"]*"|'[^']*')"""
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#64;", "@"), ("&amp;", "&"))


def page_kinds(html: Column, patterns: dict[str, str] = PAGE_KINDS) -> Column:
    """Sorted kinds that a page holds in its visible text or in an ``alt``, ``title``, ``href`` or ``src``."""
    h = F.coalesce(html, F.lit(""))
    text = F.concat_ws(" ", F.regexp_replace(h, UNSEEN, " "), F.array_join(F.regexp_extract_all(h, F.lit(SAYING), F.lit(1)), " "))
    for entity, c in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(c))
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?i){p}"), F.lit(k)) for k, p in sorted(patterns.items())]))


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, kind, start, end, value_sha256, placeholder`` of every match; values themselves are not returned."""
    patterns = {k: re.compile(p) for k, p in KINDS.items()}
    placeholder = re.compile(PLACEHOLDERS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(k, kind, m.start(), m.end(), hashlib.sha256(m[0].encode()).hexdigest(), bool(placeholder.search(m[0]))) for k, t in zip(f["k"], f["t"]) for kind, p in patterns.items() for m in p.finditer(t)]
            yield pd.DataFrame(rows, columns=["id", "kind", "start", "end", "value_sha256", "placeholder"])

    some = docs.where(F.size(kinds(F.col(text))) > 0).select(F.col(key).alias("k"), F.col(text).alias("t"))
    return some.mapInPandas(run, "id long, kind string, start int, end int, value_sha256 string, placeholder boolean")


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text, replaced``: every finding that is no placeholder becomes ``<kind-xxxxxxxx>``, the same for equal values."""
    patterns = {k: re.compile(p) for k, p in KINDS.items()}
    placeholder = re.compile(PLACEHOLDERS)

    def one(t: str | None) -> tuple[str | None, int]:
        if not t:
            return t, 0
        n = 0
        for kind, p in patterns.items():
            def put(m, kind=kind):
                nonlocal n
                if placeholder.search(m[0]):
                    return m[0]
                n += 1
                return f"<{kind}-{hashlib.sha256(m[0].encode()).hexdigest()[:8]}>"

            t = p.sub(put, t)
        return t, n

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [one(t) for t in f["t"]]
            yield pd.DataFrame({"id": f["k"], "text": [x[0] for x in out], "replaced": [x[1] for x in out]})

    # texts without a kind need no worker
    asked = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), (F.size(kinds(F.col(text))) > 0).alias("some"))
    clean = asked.where("not some").select(F.col("k").alias("id"), F.col("t").alias("text"), F.lit(0).alias("replaced"))
    return asked.where("some").select("k", "t").mapInPandas(run, "id long, text string, replaced int").unionByName(clean)


def relevance(title: Column, body: Column, focus: str, other: str) -> Column:
    """``include``, ``exclude`` or ``review``: does the text treat the subject in ``focus``, or another?"""
    return (
        F.when(~F.concat_ws(" ", title, body).rlike(focus), "exclude")
        .when(title.rlike(focus) & ~title.rlike(other), "include")
        .when(title.rlike(other) & ~body.rlike(focus), "exclude").otherwise("review"))


def match_findings(original: DataFrame, final: DataFrame) -> DataFrame:
    """Multiset join of findings on (id, kind, value): ``matched``, ``lost`` or ``new``, the n-th with the n-th."""
    from pyspark.sql import Window

    key = ["id", "kind", "value_sha256"]
    n = F.row_number().over(Window.partitionBy(*key).orderBy("start"))
    a = original.select(*key, n.alias("n"), F.lit(True).alias("before"))
    b = final.select(*key, n.alias("n"), F.lit(True).alias("after"))
    return a.join(b, [*key, "n"], "full_outer").select(*key, "n", F.when(F.col("before") & F.col("after"), "matched").when(F.col("before"), "lost").otherwise("new").alias("verdict"))
