"""Quality rules: a table of thresholds compiled into projections, without user functions.

Every rule is a row of ``RULES``: measure * scale compared with bound * base.  All numbers
are integers, so a verdict never depends on rounding.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklab.llm.common import WORD, sheltered, words

# Frequent words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to a in that is it for on as with was be by at this are from "
    "de la le et les des un une en du que qui dans pour est pas sur au avec "
    "der die das und ist von zu den mit dem nicht ein eine auf für im sich als "
    "el los las y por con no una su para es al lo del se"
).split()


class Rule(NamedTuple):
    """Fails unless low * base <= 100 * measure <= high * base; a missing bound always holds."""

    name: str
    measure: str
    base: str
    low: int | None = None
    high: int | None = None


# Bounds in percent of the base measure.
BASE_RULES = (
    Rule("enough_words", "n_words", "one", low=5000),
    Rule("repeated_words", "n_repeat_words", "n_words", high=50),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("capitals", "n_capitals", "word_chars", high=30),
    Rule("stop_words", "n_stop_words", "one", low=200),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=30),
)


def _holds(rule: Rule, measure: dict[str, Column]) -> Column:
    value, base = F.lit(100) * measure[rule.measure], measure[rule.base]
    checks = []
    if rule.low is not None:
        checks.append(value >= F.lit(rule.low) * base)
    if rule.high is not None:
        checks.append(value <= F.lit(rule.high) * base)
    out = checks[0]
    for check in checks[1:]:
        out = out & check
    return out


def passes(rules: tuple[Rule, ...], measure: dict[str, Column]) -> Column:
    """True where every rule of the table holds."""
    out = F.lit(True)
    for rule in rules:
        out = out & _holds(rule, measure)
    return out


@sheltered("_w", "_lines", "_keys", "_tagged", "_heads", "_at")
def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """All measures of the rules as long columns beside the columns of ``df``.

    A null text counts as empty: every measure is 0.
    """
    kept = df.columns
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.select("*", words(body).alias("_w"), F.split(body, "\n").alias("_lines"))
    # lines with a word
    out = out.withColumn("_lines", F.filter("_lines", lambda s: F.rlike(s, F.lit(WORD))))
    n = F.size("_w")
    inner = F.slice("_w", F.lit(1), F.greatest(n - 2, F.lit(1)))
    out = out.withColumn("_keys", F.when(n >= 3, F.transform(
        inner, lambda w, i: F.xxhash64(w, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)))))
    # A window's text and its position make one string; sorting brings equal windows together.
    # Words hold no space, so only equal windows share the text before the position.  Texts
    # whose windows all hash differently have no equal pair and skip this.
    tagged = F.sort_array(F.transform(inner, lambda w, i: F.concat(
        w, F.lit(" "), F.get(F.col("_w"), i + 1), F.lit(" "), F.get(F.col("_w"), i + 2), F.lit(" "),
        F.lpad(i.cast("string"), 10, "0"))))
    out = out.withColumn("_tagged", F.when(F.size(F.array_distinct("_keys")) < F.size("_keys"), tagged))
    out = out.withColumn("_heads", F.transform("_tagged", lambda s: F.substring(s, F.lit(1), F.length(s) - 10)))
    out = out.withColumn("_at", F.sort_array(F.filter(F.transform(
        "_tagged",
        lambda s, i: F.when(
            (F.get(F.col("_heads"), i) == F.get(F.col("_heads"), i - 1))
            | (F.get(F.col("_heads"), i) == F.get(F.col("_heads"), i + 1)),
            F.substring(s, F.length(s) - 9, F.lit(10)).cast("long"),
        ),
    ), lambda p: p.isNotNull())))
    covered = F.aggregate(
        "_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(p, acc["to"])).alias("n"), (p + 3).alias("to")),
        lambda acc: acc["n"],
    )
    new = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_capitals": F.regexp_count(body, F.lit(r"\p{Lu}")),
        "n_stop_words": F.size(F.filter("_w", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size("_lines"),
        "n_bullet_lines": F.size(F.filter("_lines", lambda s: F.rlike(s, F.lit(r"^[\x20\x09-\x0D]*[-*•]")))),
        "n_ellipsis_lines": F.size(F.filter("_lines", lambda s: F.rlike(s, F.lit(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))),
    }
    return out.select(*[F.col(f"`{c}`") for c in kept if c not in new], *[c.cast("long").alias(k) for k, c in new.items()])


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row.

    Rows are judged one by one: repeated rows get equal verdicts, null and empty texts fail
    the base rules.  Columns of the input with a result's name are replaced by the result.
    """
    out = measures(df, text)
    measure = {r.measure: F.col(r.measure) for r in (*BASE_RULES, *RULES)}
    measure |= {r.base: F.col(r.base) for r in (*BASE_RULES, *RULES) if r.base != "one"} | {"one": F.lit(1)}
    out = out.withColumn("base_failed", ~passes(BASE_RULES, measure))
    return out.withColumn("kept", ~F.col("base_failed") & passes(RULES, measure))
