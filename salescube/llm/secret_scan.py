"""Secrets in text: fixed patterns, and strings whose sliding-window entropy is high for their character class. Native columns only.

Base spans, leftmost and non-overlapping per kind, in code points with exclusive ends:
- assign: a name such as `password` or `api_key`, a colon or equals sign, and a value of 6 characters or more;
- access: `AKIA` and capitals or digits, 20 characters or more;
- hex: 24 or more of 0-9 and a-f.
Entropy spans: strings of 20 or more characters of `A-Za-z0-9+/_=-` that touch no base span. Parts of a string between its
separators that the allow-list matches (placeholders, sequences, repeated characters) are cut out, and what is left in one piece of
20 characters or more is judged; a UUID is no candidate. A window of 20 characters slides over the piece; the counts of the
character that leaves and the one that enters update the sum of c * log2(c), which gives the window's Shannon entropy. The string is
a secret if any window of a piece reaches the threshold of the piece's class: only hexadecimal digits, only letters and digits, or
the whole alphabet, each with two digits and two letters; letters are pieces with fewer digits that have two capitals and two small
letters. Numbers and words in one case are not told from secrets by entropy and belong to no class. The largest entropy that a
document's pieces reach is returned for every class.

Positions come from splitting the text at the pattern: the lengths of pieces and matches add up. Everything is a projection over
the scan: no shuffle, no Python on the executors.

Defined cases: null and empty texts have no spans; repeated rows each come back; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Kinds in their order, and the patterns.
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
#: Bits of entropy a window of 20 characters must reach, by class.
THRESHOLDS = {"hex": 3.0, "alphanumeric": 3.6, "mixed": 3.8, "letters": 4.0}
#: Matched against the parts between separators (each with the separator that ends it), and against the whole string.
ALLOWED = [
    "(?i)example|sample|placeholder|your[_-]|changeme|xxxx|test[_-]",
    "(?i)0123456789|123456789|abcdefghij|qwertyuiop",
    r"(.)\1{7}",
]
ALLOWED_WHOLE = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SEPARATOR_BEFORE = "(?<=[/_=-])"

_NO_SPANS = "cast(array() as array<struct<start:int,rank:int,till:int>>)"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(text: str, pattern: str, rank: int, length: str = "length(found[i]) > 0", values: str | None = None) -> str:
    """Array of spans of the pattern's matches; `length` keeps a match (found[i], and value[i] if a group is given)."""
    regex = _quoted(pattern)
    step = ("(a, i) -> named_struct('at', a.at + length(gaps[i]) + length(found[i]), 'spans', "
            f"if({length}, concat(a.spans, array(named_struct('start', a.at + length(gaps[i]), 'rank', {rank}, "
            "'till', a.at + length(gaps[i]) + length(found[i])))), a.spans))")
    walk = f"aggregate(sequence(0, size(found) - 1), named_struct('at', 0, 'spans', {_NO_SPANS}), {step}, a -> a.spans)"
    if values:
        walk = f"transform(array({values}), value -> {walk})[0]"
    gaps = f"transform(array(split({text}, {regex}, -1)), gaps -> {walk})[0]"
    found = f"transform(array(regexp_extract_all({text}, {regex}, 0)), found -> {gaps})[0]"
    return f"if({text} rlike {regex}, {found}, {_NO_SPANS})"


def _sum_part(count: str) -> str:
    return f"if({count} > 0, {count} * log2(greatest({count}, 1)), 0D)"


def _most_entropy(text: str) -> str:
    """The largest entropy of any window of the string."""
    held = "(length(w) - length(replace(w, {ch}, '')))"
    leaving, entering = held.format(ch="substr(w, 1, 1)"), held.format(ch="ch")
    drop = (f"transform(array(a.w), w -> if(length(w) < {WINDOW}, named_struct('w', w, 's', a.s), named_struct('w', substr(w, 2), "
            f"'s', a.s - {_sum_part(leaving)} + {_sum_part(f'({leaving} - 1)')})))[0]")
    add = (f"transform(array(d.w), w -> named_struct('w', concat(w, ch), 's', d.s - {_sum_part(entering)} + {_sum_part(f'({entering} + 1)')}))[0]")
    keep = (f"named_struct('w', e.w, 's', e.s, 'best', if(length(e.w) = {WINDOW}, greatest(a.best, log2({WINDOW}) - e.s / {WINDOW}), a.best))")
    step = f"(a, ch) -> transform(array({drop}), d -> transform(array({add}), e -> {keep})[0])[0]"
    return f"aggregate(split({text}, ''), named_struct('w', '', 's', 0D, 'best', 0D), {step}, a -> a.best)"


def _class_of(text: str) -> str:
    """Name of the piece's class; null for pieces of no class."""
    mixed = f"regexp_count({text}, '[0-9]') >= 2 and regexp_count({text}, '[A-Za-z]') >= 2"
    letters = f"regexp_count({text}, '[0-9]') < 2 and regexp_count({text}, '[A-Z]') >= 2 and regexp_count({text}, '[a-z]') >= 2"
    return (f"case when {mixed} then case when {text} rlike '^[0-9A-Fa-f]+$' then 'hex' when {text} rlike '^[0-9A-Za-z]+$' then 'alphanumeric' "
            f"else 'mixed' end when {letters} then 'letters' end")


def _pieces(text: str) -> str:
    """What the allow-list leaves of a candidate: array of (class, bits), one per piece of a class."""
    allowed = " or ".join(f"p rlike {_quoted(a)}" for a in ALLOWED)
    parts = f"transform(split({text}, {_quoted(SEPARATOR_BEFORE)}), p -> if({allowed}, ' ', p))"
    left = f"filter(split(array_join({parts}, ''), ' '), q -> length(q) >= {WINDOW} and not q rlike {_quoted(ALLOWED_WHOLE)})"
    classed = f"filter(transform({left}, q -> named_struct('text', q, 'class', {_class_of('q')})), q -> q.class is not null)"
    return f"transform({classed}, q -> named_struct('class', q.class, 'bits', {_most_entropy('q.text')}))"


def _reached(piece: str) -> str:
    bits = " ".join(f"when '{name}' then {least}D" for name, least in THRESHOLDS.items())
    return f"{piece}.bits >= case {piece}.class {bits} end"


def _listed(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"concat_ws(',', transform({spans}, s -> concat({names}[s.rank], ':', s.start, ':', s.till)))"


def scan(documents: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, all spans as text, the largest
    window entropy by class (bits_hex and so on; 0 without a piece of the class), and all spans as structs."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    assign = _spans("text", ASSIGN, 0, "length(value[i]) >= 6", f"regexp_extract_all(text, {_quoted(ASSIGN)}, 2)")
    found = docs.select(
        "doc_id", "text",
        F.expr(f"if(contains(text, '=') or contains(text, ':'), {assign}, {_NO_SPANS})").alias("assign"),
        F.expr(f"if(contains(text, 'AKIA'), {_spans('text', ACCESS, 1)}, {_NO_SPANS})").alias("access"),
        F.expr(_spans("text", HEX, 2)).alias("hex"),
        F.expr(_spans("text", CANDIDATE, 3)).alias("candidates"))
    found = found.withColumn("base", F.expr("array_sort(concat(assign, access, hex))"))
    string = "substring(text, c.start + 1, c.till - c.start)"
    untouched = "not exists(base, b -> b.start < c.till and b.till > c.start)"
    found = found.withColumn("judged", F.expr(
        f"transform(filter(candidates, c -> {untouched}), c -> named_struct('span', c, 'pieces', transform(array({string}), s -> {_pieces('s')})[0]))"))
    found = found.withColumn("entropy", F.expr(f"transform(filter(judged, j -> exists(j.pieces, q -> {_reached('q')})), j -> j.span)"))
    found = found.withColumn("reached", F.expr("flatten(judged.pieces)"))
    found = found.withColumn("all_spans", F.expr("array_sort(concat(base, entropy))"))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(F.expr(_listed("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(_listed("all_spans")).alias("spans"),
        *(F.expr(f"coalesce(array_max(transform(filter(reached, q -> q.class = '{k}'), q -> q.bits)), 0D)").alias(f"bits_{k}") for k in THRESHOLDS),
        F.expr("transform(all_spans, s -> named_struct('kind', array(" + ", ".join(f"'{k}'" for k in KINDS) + ")[s.rank], 'start', s.start, 'till', s.till))").alias("span_list"))


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("span_list")
