"""Quality rules as a short-circuit cascade of native column expressions.

A document is rejected if it breaks a rule. The cascade evaluates rules one after another and stops at the first broken one, so
their order decides the cost. It is found on a sample (`SAMPLE` documents, those whose doc_id, or text without one, has the smallest
hash, less those of over `SAMPLE_CHARS` characters). Each rule's verdicts are kept there, and its cost is the time of evaluating it
`REPEATS` times on every text, least of `RUNS` runs, less the time of the same job with a rule that costs nothing. Costs count in
steps of a factor of two, so that chance does not move them. Then the rule with the most rejections by cost among the rows that
are left goes next; ties go by name. The verdict is the same for every order.

Words are runs of characters other than ASCII white space. The rules read these measures: n_words, word_chars (code points in
words), n_symbols (characters of #*$%&|<>), n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words under
five-word windows found twice or more in the text, told apart by 64-bit hashes).

Everything is a projection over the scan: no shuffle, no Python on the executors. Sorting keeps the repeated windows of a text of
n words at n log n steps.

Defined cases: null and empty texts have no words and are rejected; a line of white space is no line; repeated rows are judged
each; an empty table gives an empty result; other columns are ignored by `measured` and kept by `clean`, whatever their names.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, functions as F

from salescube.sources.scratch import stage

SAMPLE, SAMPLE_CHARS = 1_000, 20_000
REPEATS, RUNS = 5, 2
WINDOW = 5
#: White space that parts words, characters counted as symbols.
SPACE = r"[\\x20\\x09-\\x0D]"
INK = r"[^\\x20\\x09-\\x0D]"
SYMBOLS = r"[#*$%&|<>]"

_TEXT = "coalesce({text}, '')"
_WORDS = f"filter(split({_TEXT}, '{SPACE}+'), w -> w <> '')"


def _let(value: str, name: str, body: str) -> str:
    """`body` with `name` standing for `value`, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str) -> str:
    window = ", ".join(f"w[i + {k}]" for k in range(WINDOW))
    hashes = f"transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({window}))"
    placed = "array_sort(transform(h, (x, i) -> struct(x as x, i as i)))"
    again = "filter(p, (q, k) -> (k > 0 and p[k - 1].x = q.x) or (k + 1 < size(p) and p[k + 1].x = q.x))"
    covered = (f"aggregate(sort_array(transform({again}, q -> q.i)), struct(0 as till, 0L as n), "
               f"(a, i) -> struct(i + {WINDOW} as till, a.n + i + {WINDOW} - greatest(a.till, i) as n), a -> a.n)")
    found = _let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {_let(placed, 'p', covered)})")
    return _let(words, "w", f"if(size(w) < {WINDOW}, 0L, {found})")


def _measures(text: str, words: str) -> dict[str, str]:
    whole = _TEXT.format(text=text)
    lines = f"filter(split({whole}, '\\n'), x -> x rlike '{INK}')"
    return {
        "n_words": f"cast(size({words}) as bigint)",
        "word_chars": f"cast(length({whole}) - regexp_count({whole}, '{SPACE}') as bigint)",
        "n_symbols": f"cast(regexp_count({whole}, '{SYMBOLS}') as bigint)",
        "n_dup_lines": _let(lines, "x", "cast(size(x) - size(array_distinct(x)) as bigint)"),
        "n_repeat_words": _repeat_words(words),
    }


def _rules(m: dict[str, str], text: str) -> dict[str, str]:
    """Conditions under which a document is rejected. Whole numbers only, so that no rounding decides."""
    whole = _TEXT.format(text=text)
    return {
        "few_words": f"{m['n_words']} < 10",
        "symbols": f"2 * {m['n_symbols']} > {m['n_words']}",
        "word_length": f"{m['word_chars']} < 2 * {m['n_words']} or {m['word_chars']} > 15 * {m['n_words']}",
        "shouting": f"2 * regexp_count({whole}, '[A-Z]') > {m['word_chars']}",
        "dup_lines": f"2 * {m['n_dup_lines']} > size(split({whole}, '\\n'))",
        "repeat_words": f"100 * {m['n_repeat_words']} > 20 * {m['n_words']}",
    }


def _sampled(documents: DataFrame, sample: int) -> DataFrame:
    """Texts of the rows with the smallest hashes. Hashes are picked first, so that tasks pass on numbers instead of texts."""
    key = F.xxhash64("doc_id" if "doc_id" in documents.columns else "text")
    picked = [r[0] for r in documents.select(key.alias("key")).orderBy("key").limit(sample).collect()]
    return documents.where(key.isin(picked) & (F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS)).select("text").limit(sample)


def _seconds(held: DataFrame, broken: str) -> float:
    """Time of evaluating a rule `REPEATS` times on each text."""
    again = held.select(F.explode(F.sequence(F.lit(1), F.lit(REPEATS))), "*")
    begun = time.perf_counter()
    again.agg(F.count_if(F.expr(broken))).collect()
    return time.perf_counter() - begun


def _order(costs: dict[str, float], verdicts: list) -> list[str]:
    """Rules by rejection per cost, each on the rows that the rules before it leave; `verdicts` say by row which rules are broken."""
    steps = {name: 2.0 ** round(math.log2(cost)) for name, cost in costs.items()}
    order, rows = [], verdicts
    while len(order) < len(steps):
        rest = sorted(set(steps) - set(order))
        order.append(max(rest, key=lambda n: (sum(r[n] for r in rows) / steps[n], -steps[n])))
        rows = [r for r in rows if not r[order[-1]]]
    return order


def estimates(documents: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], list]:
    """Cost of each rule in seconds per evaluation of the whole sample, and the verdicts on it."""
    held = stage(_sampled(documents, sample).withColumn("words", F.expr(_WORDS.format(text="text"))), "sample")
    rules = _rules(_measures("text", "words"), "text")
    idle = min(_seconds(held, "size(words) < 0") for _ in range(RUNS))
    costs = {n: max(min(_seconds(held, broken) for _ in range(RUNS)) - idle, 0.01) / REPEATS for n, broken in rules.items()}
    return costs, held.select(*(F.expr(broken).alias(name) for name, broken in rules.items())).collect()


def cascade_order(documents: DataFrame, sample: int = SAMPLE) -> list[str]:
    """Rules by rejection per cost on the sample, each on what the rules before it leave."""
    return _order(*estimates(documents, sample))


def _verdict(rules: dict[str, str], order: list[str]) -> str:
    """Whether no rule is broken; a rule is evaluated only if those before it hold."""
    return "case " + " ".join(f"when {rules[n]} then false" for n in order) + " else true end"


def measured(documents: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per document row: doc_id, the measures, base_failed and kept."""
    order = order or cascade_order(documents)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("words", F.expr(_WORDS.format(text="text")))
    measures = _measures("text", "words")
    names = {name: name for name in measures}
    out = docs.select("doc_id", "text", *(F.expr(e).alias(n) for n, e in measures.items()))
    out = out.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    return out.withColumn("kept", F.expr(f"not base_failed and {_verdict(_rules(names, 'text'), order)}")).drop("text")


def clean(documents: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The documents that break no rule, with the columns they had; measures are computed only as far as the cascade goes."""
    order = order or cascade_order(documents)
    words = _WORDS.format(text="text")
    return documents.where(F.expr(_verdict(_rules(_measures("text", words), "text"), order)))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents."""
    return measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
