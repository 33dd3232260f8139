"""Quality rules as a short-circuit cascade of DataFrame expressions.

Each rule is a boolean expression over the text's measures. Selectivity and cost of every rule
are measured on a bounded sample; rules then stand in one CASE expression in the order of
rejections per cost, so that a row stops at the first rule that rejects it. The order never
changes which rows are kept, only how much is computed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.llm.common import materialize, table, text_or_empty

#: White space that parts words (fixed by the contract).
SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Most rows of the random sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 1000


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    trimmed = F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that stand in a window found twice or more in the text.

    Windows are compared by hash first: where all hashes differ there is none. Otherwise windows
    and their places are sorted as strings, so equal ones are neighbours; each place of a repeated
    window covers `window` words, less what the next such place covers.
    """
    size = F.size(words)
    places = F.sequence(F.lit(1), size - window + 1)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(window)]))
    pairs = F.array_sort(F.transform(places, lambda i: F.struct(F.array_join(F.slice(words, i, window), " ").alias("w"), i.alias("i"))))

    def covered(sorted_pairs: Column) -> Column:
        n = F.size(sorted_pairs)

        def same(a: Column, b: Column) -> Column:
            return F.get(sorted_pairs, a)["w"] == F.get(sorted_pairs, b)["w"]

        kept = F.filter(F.transform(sorted_pairs, lambda p, k: F.when(((k > 0) & same(k, k - 1)) | ((k < n - 1) & same(k, k + 1)), p["i"])), lambda i: i.isNotNull())
        return F.transform(F.array(F.array_sort(kept)), lambda at: F.aggregate(
            F.transform(at, lambda i, k: F.coalesce(F.least(F.get(at, k + 1) - i, F.lit(window)), F.lit(window))), F.lit(0).cast("long"), lambda a, b: a + b
        ))[0]

    exact = F.transform(F.array(pairs), covered)[0]
    unique = F.transform(F.array(hashes), lambda h: F.size(F.array_distinct(h)) == F.size(h))[0]
    return F.when(size < window + 1, F.lit(0).cast("long")).when(unique, F.lit(0).cast("long")).otherwise(exact)


@dataclass(frozen=True)
class Measures:
    """Expressions of a text's measures."""

    text: Column
    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_dup_lines: Column
    n_repeat_words: Column

    @classmethod
    def of(cls, text: Column, words: Column) -> Measures:
        return cls(
            text,
            F.size(words).cast("long"),
            F.length(without(text, SPACES)).cast("long"),
            (F.length(text) - F.length(without(text, SYMBOLS))).cast("long"),
            n_dup_lines(text),
            n_repeat_words(words),
        )

    @classmethod
    def columns(cls, text: Column) -> Measures:
        return cls(text, *[F.col(n) for n in NAMES])


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule rejects where `fails`, an expression over the measures, is true."""

    name: str
    fails: Callable[[Measures], Column]


def default_rules() -> list[Rule]:
    """The base rules (too short, too repetitive) and four more."""
    return [
        Rule("too_short", lambda m: m.n_words < 10),
        Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
        Rule("symbols", lambda m: 100 * m.n_symbols > 30 * m.n_words),
        Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 25 * m.n_words)),
        Rule("repeated_lines", lambda m: m.n_dup_lines * 10 > 5 * (1 + F.length(m.text) - F.length(without(m.text, "\n")))),
        Rule("shouting", lambda m: F.regexp_count(m.text, F.lit(r"\p{Lu}")) * 2 > m.word_chars),
    ]


def _now() -> Column:
    """Nanoseconds of the executor's clock, read anew for every row."""
    return F.call_function("java_method", F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")


def rule_statistics(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[int, int]]:
    """Rejected rows and nanoseconds of each rule over a random sample of docs, which has a column text.

    Words are made before the clock starts, as all rules share them. An expression with rand() in
    it is evaluated where it stands, so each rule lies between two readings of the clock.
    """
    n = docs.count()
    if not n:
        return [(0, 0) for _ in rules]
    sample = docs.select(text_or_empty().alias("text")).sample(min(1.0, 1.2 * sample_rows / n + 1e-9), seed=7).limit(sample_rows)
    sample = materialize(sample.withColumn("words", words_of(F.col("text"))), "quality-sample")
    measures = Measures.of(F.col("text"), F.col("words"))
    columns = [_now().alias("t0")]
    for k, r in enumerate(rules):
        columns += [F.when(F.rand(k) >= 0, r.fails(measures)).alias(f"f{k}"), _now().alias(f"t{k + 1}")]
    sums = [F.coalesce(F.count_if(f"f{k}"), F.lit(0)).alias(f"f{k}") for k in range(len(rules))] + [F.coalesce(F.sum(F.col(f"t{k + 1}") - F.col(f"t{k}")), F.lit(0)).alias(f"n{k}") for k in range(len(rules))]
    row = sample.select(*columns).agg(*sums).first()
    return [(row[f"f{k}"], row[f"n{k}"]) for k in range(len(rules))]


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by estimated rejections per nanosecond on a sample, best first."""
    worth = [failed / max(1, spent) for failed, spent in rule_statistics(docs, rules, sample_rows)]
    return [r for _, r in sorted(zip(worth, rules, strict=True), key=lambda x: -x[0])]


def _with_words(text: Column, body: Callable[[Column, Column], Column]) -> Column:
    """body(text, words) with both bound to variables, so that neither is worked out more than once."""
    return F.transform(F.array(F.struct(text.alias("t"), words_of(text).alias("w"))), lambda x: body(x["t"], x["w"]))[0]


def cascade(rules: Sequence[Rule], measures: Measures) -> Column:
    """Name of the first rule that rejects, else null. CASE stops at the first that holds."""
    said = F.lit(None).cast("string")
    for r in reversed(rules):
        said = F.when(r.fails(measures), F.lit(r.name)).otherwise(said)
    return said


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that no rule rejects, with their columns as they are.

    One expression in a filter: measures of rules behind the first that rejects aren't computed.
    Nulls, repeated rows and empty tables as in apply_rules.
    """
    ordered = order_rules(docs.select(F.col(text_col).alias("text")), rules or default_rules(), sample_rows)
    return docs.where(_with_words(text_or_empty(text_col), lambda t, w: cascade(ordered, Measures.of(t, w))).isNull())


def apply_rules(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Measures and verdict for every row: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, rejected_by; the columns of docs of these names, and one that
    is named words, give way.

    A null or empty text has no words and fails as too short. Repeated rows are judged each for
    itself; an empty table gives an empty result. Very long texts are measured whole. DataFrame
    functions only, no shuffle.
    """
    own = [*NAMES, "base_failed", "kept", "rejected_by", "words"]
    text = text_or_empty(text_col)
    ordered = order_rules(docs.select(F.col(text_col).alias("text")), rules or default_rules(), sample_rows)
    staged = docs.drop(*[c for c in docs.columns if c in own and c != text_col]).withColumn("words", words_of(text))
    m = Measures.of(text, F.col("words"))
    measured = staged.withColumns({n: getattr(m, n) for n in NAMES})
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = measured.withColumn("rejected_by", cascade(ordered, Measures.columns(text))).withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop("words")


def op1_quality(spark, sf_dir: str) -> DataFrame:
    judged = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *NAMES, "base_failed", "kept")
