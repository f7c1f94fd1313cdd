"""Rule-based quality filter: one table of thresholds, compiled into one Spark projection.

Every feature is a built-in expression over the whole text, so the filter is a scan without a
shuffle and without user functions.

Defined results: a null, empty or blank text has no words and fails the base rules. Repeated rows
are judged one by one. Columns of the input other than ``doc_id`` and ``text`` pass through
``quality_filter`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.llm.words import SPACES, words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu "
    "au avec dans de des du en est et la le les ou par pas pour que qui sur un une "
    "al con de del el en es la las lo los no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject when ``feature`` leaves [least, most]; only texts of ``from_words`` words or more are held to it."""

    name: str
    feature: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The base rules of the contract, then length, symbol, stop-word and line ratios.
BASE_RULES = (
    Rule("too_few_words", "n_words", least=20),
    Rule("repeated_windows", "repeat_percent", most=30),
)
RULES = (
    Rule("short_words", "mean_word_chars", least=2.5),
    Rule("long_words", "mean_word_chars", most=12),
    Rule("symbols", "symbol_ratio", most=0.10),
    Rule("exclamations", "exclamation_ratio", most=0.30),
    Rule("few_stop_words", "stop_ratio", least=0.03, from_words=30),
    Rule("duplicate_lines", "dup_line_ratio", most=0.50),
    Rule("ellipsis_lines", "ellipsis_line_ratio", most=0.50),
)
WINDOW = 8


def _repeated_words(w: Column) -> Column:
    """Words inside ``WINDOW``-word windows whose words occur twice or more in the text."""
    last = F.size(w) - WINDOW
    # one 64-bit hash a window; two different windows of one text agree with a chance below n^2 / 2^65
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(w, i + 1, F.lit(WINDOW))))

    def covered(h: Column) -> Column:
        at = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = F.filter(
            F.transform(F.array(at), lambda s: F.filter(
                F.transform(s, lambda x, k: F.when(
                    (F.when(k > 0, s[k - 1]["h"]) == x["h"]) | (F.when(k < F.size(s) - 1, s[k + 1]["h"]) == x["h"]), x["i"])),
                lambda i: i.isNotNull()))[0],
            lambda i: i.isNotNull())
        starts = F.array_sort(twice)
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("p")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["p"])).alias("n"), i.alias("p")),
            lambda a: a["n"])

    several = F.transform(F.array(hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))[0]
    return F.when(last < 1, F.lit(0)).otherwise(several).cast("long")


def features(text: Column) -> Column:
    """A struct of counts and ratios of one text."""
    t = F.coalesce(text, F.lit(""))
    stops = sorted(set(STOP_WORDS))

    def count_of(chars: str) -> Column:
        """How often any of some characters occurs."""
        return sum((F.length(t) - F.length(F.replace(t, F.lit(c), F.lit(""))) for c in chars), F.lit(0)).cast("long")

    def counts(w: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
        n = F.size(w).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            count_of("#*$%&|<>").alias("n_symbols"),
            F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
            count_of("!").alias("n_exclamations"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*stops))).cast("long").alias("n_stop_words"),
            _repeated_words(w).alias("n_repeat_words"),
        )

    return F.transform(F.array(words(text)), counts)[0]


def _value(f: Column, feature: str) -> Column:
    n, lines = F.greatest(f["n_words"], F.lit(1)), F.greatest(f["n_lines"], F.lit(1))
    return {
        "n_words": f["n_words"],
        "repeat_percent": 100 * f["n_repeat_words"] / n,
        "mean_word_chars": f["word_chars"] / n,
        "symbol_ratio": f["n_symbols"] / n,
        "exclamation_ratio": f["n_exclamations"] / n,
        "stop_ratio": f["n_stop_words"] / n,
        "dup_line_ratio": f["n_dup_lines"] / lines,
        "ellipsis_line_ratio": f["n_ellipsis_lines"] / lines,
    }[feature]


def compile_rules(f: Column, rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that reject, in the table's order."""
    def breaks(r: Rule) -> Column:
        v = _value(f, r.feature)
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (v < r.least)
        if r.most is not None:
            bad = bad | (v > r.most)
        return F.when((f["n_words"] >= r.from_words) & bad, F.lit(r.name))

    return F.array_compact(F.array(*[breaks(r) for r in rules]))


def quality_report(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """``keep`` columns, the features, ``failed`` (names of rules), ``base_failed`` and ``kept``; a row for each input row."""
    f = F.col("__f")
    return (
        docs.select(*keep, features(F.col(text)).alias("__f"))
        .select(*keep, f, compile_rules(f, base).alias("__b"), compile_rules(f, rules).alias("__r"))
        .select(
            *keep, "__f.*",
            F.concat("__b", "__r").alias("failed"),
            (F.size("__b") > 0).alias("base_failed"),
            ((F.size("__b") == 0) & (F.size("__r") == 0)).alias("kept"),
        )
    )


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    def stays(f: Column) -> Column:
        return (F.size(compile_rules(f, base)) == 0) & (F.size(compile_rules(f, rules)) == 0)

    # one lambda binds the features, so that the filter evaluates them once a row
    return docs.where(F.transform(F.array(features(F.col(text))), stays)[0])
