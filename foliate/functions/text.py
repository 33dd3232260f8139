"""Column expressions for text, hashes and spans. Offsets are 0-based and count code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() sees it, which Java's \s alone does not.
SPACE = r"[\s\x1c-\x1f]"


def collapse_space(x: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(x, f"(?U){SPACE}+", " "))


def strip_right(x: Column) -> Column:
    return F.regexp_replace(x, f"(?U){SPACE}+\\z", "")


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"(?U)\\A{SPACE}+|{SPACE}+\\z", "")


def find(text: Column, quote: Column, start: Column | int = 0) -> Column:
    """Offset of the first occurrence from start on, or -1."""
    start = F.lit(start) if isinstance(start, int) else start
    return F.call_function("locate", quote, text, start + 1) - 1


def find_last(text: Column, quote: Column, end: Column) -> Column:
    """Offset of the last occurrence that ends at or before end, or -1."""
    prefix = F.left(text, end)
    back = F.call_function("locate", F.reverse(quote), F.reverse(prefix))
    return F.when(back > 0, F.length(prefix) - (back - 1) - F.length(quote)).otherwise(-1)


def count_of(text: Column, quote: Column) -> Column:
    """Number of occurrences that don't overlap."""
    return F.floor((F.length(text) - F.length(F.replace(text, quote, F.lit("")))) / F.nullif(F.length(quote), F.lit(0))).cast("int")


def span(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def tokens(x: Column) -> Column:
    """Distinct case-folded tokens of ASCII letters and digits."""
    folded = F.lower(F.replace(F.replace(x, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss")))
    return F.array_distinct(F.regexp_extract_all(folded, F.lit("[a-z0-9]+"), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token sets; 0 where either is empty."""
    return F.when((F.size(a) <= 0) | (F.size(b) <= 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def overlap(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Shared length of two spans over the shorter one's; 0 where that is empty or a span is absent."""
    shared = F.greatest(F.lit(0), F.least(end1, end2) - F.greatest(start1, start2))
    there = start1.isNotNull() & end1.isNotNull() & start2.isNotNull() & end2.isNotNull()
    return F.coalesce(F.when(there, F.try_divide(shared.cast("double"), F.least(end1 - start1, end2 - start2).cast("double"))), F.lit(0.0))


def sha256(x: Column) -> Column:
    return F.sha2(x, 256)


def json_string(x: Column) -> Column:
    """A JSON string in ASCII: quotes, backslashes and controls escaped, others as \\u and four lower-case digits, in pairs above the BMP."""
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    four = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, F.lit("0")))

    def escaped(c: Column) -> Column:
        n = F.ascii(c)
        out = F.when((n >= 32) & (n < 127), c).when(n < 0x10000, four(n)).otherwise(F.concat(four(F.lit(0xD7C0) + F.floor(n / 1024)), four(F.lit(0xDC00) + n % 1024)))
        for k, v in short.items():
            out = F.when(c == k, F.lit(v)).otherwise(out)
        return out

    plain = F.regexp_like(x, F.lit(r'\A[ !#-\[\]-~]*\z'))
    return F.concat(F.lit('"'), F.when(plain, x).otherwise(F.array_join(F.transform(F.filter(F.split(x, ""), lambda c: c != ""), escaped), "")), F.lit('"'))


def pad_number(n: Column, width: int = 3) -> Column:
    """Zero-padded to the width, longer numbers in full."""
    s = n.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def pad_cik(cik: Column) -> Column:
    """Ten digits with leading zeros; longer ones stay; null where it isn't all digits."""
    return F.when(F.regexp_like(cik, F.lit("^[0-9]+$")), pad_number(cik, 10))


def safe_name(x: Column) -> Column:
    return F.regexp_replace(x, "[^A-Za-z0-9._-]", "-")


def artifact_name(response_id: Column, generated_at: Column) -> Column:
    """File stem of a proposal: its response id, else its time."""
    stamp = F.date_format(generated_at, "yyyyMMdd'T'HHmmss.SSSSSS'Z'")
    return safe_name(F.coalesce(F.nullif(response_id, F.lit("")), stamp))


def percent(x: Column) -> Column:
    """One decimal, half to even on the double; n/a for null."""
    return F.coalesce(F.concat(F.format_number(x * 100, 1), F.lit("%")), F.lit("n/a"))


def ratio(n: Column, d: Column) -> Column:
    """n / d, null where d is 0."""
    return F.try_divide(n.cast("double"), d.cast("double"))


def f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.when(precision.isNull() | recall.isNull(), F.lit(None).cast("double")).when(both == 0, F.lit(0.0)).otherwise(2 * precision * recall / both)


def sum_if_all(x: Column) -> Column:
    """Sum that is null if any value is, and 0 for none."""
    return F.when(F.count(x) == F.count(F.lit(1)), F.coalesce(F.sum(x), F.lit(0)))


def mean_of_present(*values: Column) -> Column:
    """Mean of the values that aren't null, 0 if all are."""
    there = F.filter(F.array(*values), lambda x: x.isNotNull())
    return F.coalesce(F.try_divide(F.aggregate(there, F.lit(0.0), lambda s, x: s + x), F.size(there).cast("double")), F.lit(0.0))


#: Period headings that part the chunks of a section (a fixed pattern).
PERIOD = r"(?di)\A(?:Three|Six|Nine) Months Ended .+ Compared with .+\z"
#: Words of a heading that needn't begin upper-case (fixed values).
MINOR = ("and", "of", "the")


def is_period(x: Column) -> Column:
    return F.regexp_like(x, F.lit(PERIOD))


def is_heading(x: Column) -> Column:
    """Whether a paragraph looks like a heading."""
    words = F.split(collapse_space(x), " ")
    title = F.forall(words, lambda w: F.regexp_like(w, F.lit(r"^[\p{Lu}\p{Lt}]")) | F.lower(w).isin(*MINOR))
    return (
        F.when(x.isin("PART I", "Item 2"), False)
        .when(F.contains(x, F.lit("\n")) | (F.length(x) > 120) | F.regexp_like(x, F.lit(r"[.:;]\z")), False)
        .when(is_period(x) | (~F.regexp_like(x, F.lit("[a-z]")) & (F.upper(x) == x) & (F.lower(x) != x)), True)  # case mapping is slow
        .otherwise((F.size(words) <= 8) & (F.length(collapse_space(x)) > 0) & title)
    )
