"""Quality rules: a threshold table compiled into one Spark projection, no user functions.

A rule names a ratio or count and the range a good text lies in. ``measured`` computes
the base counts from whole texts with built-in functions only, and ``judged`` turns the
table into one projection: a text fails a rule when the value lies outside the range.

Repeated words are found in linearithmic time and no row leaves its document: every
3-word window gets one long, the upper 40 bits of its hash over its position; the sorted
longs put equal windows side by side, whose words are then compared. If two neighbours
share the 40 bits but not the words, or a text has 2^24 words or more, that text takes
the same steps over the windows' words themselves, so the count is exact in every case.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import SPACE, texts

#: Bits of a window's long that hold its position.
POSITION_BITS = 24
SYMBOLS = r"[#*$%&|<>]"
#: Frequent short words of the corpus's languages; running text has some of them.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "at", "be", "this"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "pour", "dans", "pas", "qui", "au", "en"],
    "es": ["el", "la", "los", "de", "que", "y", "en", "un", "una", "por", "con", "para", "se", "del", "su", "no"],
    "de": ["der", "die", "das", "und", "ist", "von", "zu", "den", "mit", "auf", "ein", "eine", "des", "im", "in"],
}


#: Letters of these languages. A text with more of others (a fiftieth of its word characters) is in a language without
#: a list, which the rule of stop words does not judge.
LETTERS = "A-Za-zÀÂÆÇÉÈÊËÎÏÔŒÙÛÜŸàâæçéèêëîïôœùûüÿÑÁÍÓÚñáíóúÄÖẞäößªº"


@dataclass(frozen=True)
class Rule:
    """``value`` is SQL over the measured columns; it must lie in [least, most], for texts ``where`` holds."""

    name: str
    value: str
    least: float | None = None
    most: float | None = None
    where: str | None = None


#: The base rules hold whatever the table says.
BASE = (
    Rule("too_few_words", "n_words", least=50),
    Rule("repeated_words", "100 * n_repeat_words - 50 * n_words", most=0),
)
#: The method's own thresholds.
RULES = (
    Rule("word_length", "word_chars / n_words", least=2.0, most=15.0),
    Rule("symbols", "n_symbols / n_words", most=0.2),
    Rule("stop_words", "n_stop_words / n_words", least=0.02, where="50 * n_other_letters <= word_chars"),
    Rule("duplicate_lines", "n_dup_lines / n_lines", most=0.5),
    Rule("upper_case", "n_upper / word_chars", most=0.5),
)


def _longs_of_windows(bits: int) -> str:
    return (f"transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> "
            f"(xxhash64(x, get(w, i + 1), get(w, i + 2)) & {-(1 << bits)}L) | cast(i as bigint))")


def _beside(key: str) -> str:
    """Items of the sorted array ``s`` whose ``key`` equals a neighbour's; null-safe at the ends."""
    k = key.format
    return f"filter(s, (x, i) -> coalesce({k('x')} = {k('get(s, i - 1)')}, false) or coalesce({k('x')} = {k('get(s, i + 1)')}, false))"


def _covered(position: str, items: str) -> str:
    """How many words the windows at these positions cover."""
    p = position.format("x")
    return f"size(array_distinct(flatten(transform({items}, x -> array({p}, {p} + 1, {p} + 2)))))"


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stop_words: dict[str, list[str]] | None = None, position_bits: int = POSITION_BITS,
             carry: bool = False) -> DataFrame:
    """The counts the rules read, one row per input row (all long, zero for an empty text).

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word),
    n_dup_lines (those equal to an earlier line), n_repeat_words (words in 3-word windows
    found twice or more, the first included), n_stop_words, n_upper (capitals in words),
    n_other_letters (letters beyond ``LETTERS``).
    With ``carry`` also ``row``, the struct of all input columns.
    """
    stops = sorted({w for ws in (STOP_WORDS if stop_words is None else stop_words).values() for w in ws})
    carried = ["row"] if carry else []
    rows = texts(docs, id_col, text_col, carry).select(
        "doc_id", *carried, "text",
        F.expr(f"filter(split(text, r'{SPACE}'), x -> x != '')").alias("w"),
        F.expr(r"filter(split(text, '\n'), x -> x rlike r'[^\x20\x09-\x0D]')").alias("lines"))
    rows = rows.withColumn("s", F.expr(f"sort_array({_longs_of_windows(position_bits)})"))
    rows = rows.withColumn("same", F.expr(_beside(f"shiftright({{}}, {position_bits})")))
    mask = (1 << position_bits) - 1
    p, q = f"cast(x & {mask}L as int)", f"cast(get(same, i - 1) & {mask}L as int)"
    apart = " or ".join(f"get(w, {p} + {k}) != get(w, {q} + {k})" for k in range(3))
    rows = rows.withColumn("unsure", F.expr(
        f"size(w) >= {1 << position_bits} or exists(transform(same, (x, i) -> i > 0 and "
        f"shiftright(x, {position_bits}) = shiftright(get(same, i - 1), {position_bits}) and ({apart})), x -> x)"))
    by_words = ("sort_array(transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> "
                "struct(x as a, get(w, i + 1) as b, get(w, i + 2) as c, i as p)))")
    exact = f"flatten(transform(array({by_words}), s -> {_beside('struct({0}.a, {0}.b, {0}.c)')}))"
    capitals = F.length(F.regexp_replace("text", r"\P{Lu}+", ""))
    return rows.select(
        "doc_id", *carried,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("unsure"), F.expr(_covered("{0}.p", exact)))
         .when(F.size("same") == 0, F.lit(0))
         .otherwise(F.expr(_covered(f"({{0}} & {mask}L)", "same"))).cast("long").alias("n_repeat_words"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(stops))).cast("long").alias("n_stop_words"),
        capitals.cast("long").alias("n_upper"),
        F.length(F.regexp_replace("text", rf"[\P{{L}}{LETTERS}]+", "")).cast("long").alias("n_other_letters"),
    )


def fails(rule: Rule) -> Column:
    """True where the value lies outside the rule's range; a value over nothing (null) fails."""
    value = F.expr(f"try_divide({rule.value.replace(' / ', ', ')})" if " / " in rule.value else rule.value)
    out = F.lit(False)
    if rule.least is not None:
        out = out | (value < F.lit(rule.least))
    if rule.most is not None:
        out = out | (value > F.lit(rule.most))
    out = F.coalesce(out, F.lit(True))
    return out if rule.where is None else out & F.coalesce(F.expr(rule.where), F.lit(True))


def judged(counts: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """``counts`` with base_failed, kept and ``failed`` (names of the rules that a text fails)."""
    both = [*base, *rules]
    names = F.filter(F.array(*[F.when(fails(r), F.lit(r.name)) for r in both]), lambda x: x.isNotNull())
    judged_ = counts.withColumn("failed", names)
    any_of = lambda rs: F.arrays_overlap("failed", F.array(*[F.lit(r.name) for r in rs]))
    out = judged_.select("*", any_of(base).alias("base_failed"), (F.size("failed") == 0).alias("kept"))
    # One row from each row: a filter on the verdict stays above the counts instead of repeating them.
    return out.select(F.inline(F.array(F.struct("*"))))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: tuple[Rule, ...] = RULES, carry: bool = False) -> DataFrame:
    """Counts and verdict of every row of ``docs`` from one projection over its whole text.

    Null text counts as empty: all counts zero, base_failed, not kept. A null id stays
    null; repeated rows give repeated results; an empty table gives an empty result.
    """
    return judged(measured(docs, id_col, text_col, carry=carry), rules)
