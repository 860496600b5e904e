"""Personal data: fixed patterns, and identifiers found by bootstrapped contextual extraction.

Base spans, leftmost and non-overlapping per kind, in code points with exclusive ends: email addresses, IPv4 addresses with parts
up to 255, card numbers (14 to 19 digits that pass Luhn's check), phone numbers (a plus sign and 10 to 15 digits).

Bootstrapping finds identifiers that no pattern describes, by the words they follow:
1. Base entities are the seeds. The one and the two lower-cased words before an entity are its lexical patterns. A pattern that
   precedes at least `LEAST_SEEDS` distinct entities is a candidate; candidates go to a sorted store.
2. A second pass counts how often each candidate occurs in all, and lists the instances after it: the entities, and other words
   with at least four digits or an @.
3. Spark scores the graph of patterns and instances `ROUNDS` times: a pattern's confidence is the sum of its instances' confidences
   over all its occurrences, an unknown instance's is 1 less the product of what its patterns leave open; entities stay at 1.
   Patterns that confident instances follow gain by them, and lift others.
4. Patterns of at least `CONFIDENT` name what follows them: the last pass adds such words as spans of kind `context`, where no base
   span is.
Contexts are hashed; the graph has edges for entities and identifier-like words only, is joined and summed in Spark, and is
staged after every round. Tasks hold one piece of text.

Defined cases: null and empty texts have no spans; an entity at a text's start or glued to the word before it has no pattern;
repeated rows count each; an empty table gives an empty result; doc_id may be null or repeated; other columns are ignored by `scan`
and kept by `redacted`, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens
from salescube.llm.store import SortedStore, new_path, shard_bits
from salescube.sources.scratch import stage

#: Kinds in their order, and the patterns.
KINDS = ["email", "ip", "card", "phone", "context"]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LEAST_SEEDS, CONFIDENT, ROUNDS = 5, 0.5, 3
_EDGES = "\"'.,;:!?()[]{}<>|*#$%&"


def _emails(text: str):
    """Matches of local part, @ and domain: the local part reaches back from an @ as far as it can."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        at += 1
        if domain:
            free = at = domain.end()
            yield begin, free


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's rank, end), sorted."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _texts(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") if b is not None else "" for b in column.cast(pa.binary()).to_pylist()]


class _Words:
    """Words of a piece of text with the patterns before them and their places in code points."""

    def __init__(self, texts: list[str]):
        data = [t.encode("utf-8", "replace") for t in texts]
        self.offs = np.r_[0, np.cumsum([len(b) for b in data])].astype(np.int64)
        self.raw = np.frombuffer(b"".join(data), np.uint8)
        self.starts, self.ends, self.first = tokens.word_spans(self.raw, self.offs)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        points = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum((self.raw & 0xC0) != 0x80, out=points[1:])
        base = points[self.offs[:-1]][self.text]
        self.low, self.high = points[self.starts] - base, points[self.ends] - base
        names = tokens.word_hashes(tokens.lower(self.raw), self.starts, self.ends)
        place = np.arange(len(names)) - self.first[:-1][self.text]
        #: Patterns before each word: one word, two words; `has` tells whether there are so many.
        self.patterns = np.zeros((2, len(names)), np.uint64)
        self.patterns[0, 1:] = tokens.run_hashes(names, 1)[:len(names) - 1] if len(names) else 0
        if len(names) > 2:
            self.patterns[1, 2:] = tokens.run_hashes(names, 2)[:len(names) - 2]
        self.has = np.stack([place > 0, place > 1])
        self.names = names

    def identifiers(self) -> np.ndarray:
        """Words with at least four digits, or an @ inside."""
        digits = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum((self.raw >= 48) & (self.raw <= 57), out=digits[1:])
        ats = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum(self.raw == 64, out=ats[1:])
        return (digits[self.ends] - digits[self.starts] >= 4) | (ats[self.ends] > ats[self.starts])

    def covered(self, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
        """Words that a span touches."""
        out = np.zeros(len(self.low), bool)
        for text, held in enumerate(spans):
            a, b = self.first[text], self.first[text + 1]
            for begin, _, end in held:
                out[a + np.searchsorted(self.high[a:b], begin, side="right"):a + np.searchsorted(self.low[a:b], end)] = True
        return out

    def entities(self, texts: list[str], spans: list[list[tuple[int, int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word at which each entity that begins a word starts, the entity's hash, and its kind."""
        words, names, kinds = [], [], []
        for text, held in enumerate(spans):
            a, b = self.first[text], self.first[text + 1]
            for begin, kind, end in held:
                at = a + int(np.searchsorted(self.low[a:b], begin))
                if at < b and self.low[at] == begin:
                    words.append(at)
                    names.append(int.from_bytes(hashlib.blake2b(texts[text][begin:end].encode(), digest_size=8).digest(), "little"))
                    kinds.append(kind)
        return np.array(words, np.int64), np.array(names, np.uint64), np.array(kinds, np.int64)


def _seed_edges(batches):
    """(pattern, instance) of all entities."""
    for rows, _, _ in tokens.text_chunks(batches):
        texts = _texts(rows.column(0))
        words = _Words(texts)
        at, names, _ = words.entities(texts, [base_spans(t) for t in texts])
        pairs = [(words.patterns[k, at[words.has[k, at]]], names[words.has[k, at]]) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(np.concatenate(x))) for x in zip(*pairs)], names=["pattern", "instance"])


def _graph_edges(store: SortedStore):
    """(pattern, instance, seed, n): n occurrences; a null instance stands for words that are no identifiers."""
    def run(batches):
        for rows, _, _ in tokens.text_chunks(batches):
            texts = _texts(rows.column(0))
            spans = [base_spans(t) for t in texts]
            words = _Words(texts)
            seed_at, seed_names, _ = words.entities(texts, spans)
            instance = words.names.copy()
            instance[seed_at] = seed_names
            seeds = np.zeros(len(instance), bool)
            seeds[seed_at] = True
            listed = seeds | (words.identifiers() & ~words.covered(spans))
            out = []
            for k in (0, 1):
                names, back = np.unique(words.patterns[k], return_inverse=True)
                known = words.has[k] & store.find(names)[0][back]
                here = np.flatnonzero(known & listed)
                out.append((words.patterns[k, here], instance[here], seeds[here], np.ones(len(here), np.int64), np.ones(len(here), bool)))
                rest, n = np.unique(words.patterns[k, known & ~listed], return_counts=True)
                out.append((rest, np.zeros(len(rest), np.uint64), np.zeros(len(rest), bool), n, np.zeros(len(rest), bool)))
            pattern, instance, seed, n, real = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.signed(pattern)), pa.array(tokens.signed(instance), mask=~real), pa.array(seed), pa.array(n)],
                names=["pattern", "instance", "seed", "n"])
    return run


def _write(store: SortedStore):
    def run(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("pattern").to_numpy().view(np.uint64))
        shard = table.column("shard")[0].as_py()
        store.write(shard, keys)
        return pa.table({"shard": pa.array([shard], pa.int64())})
    return run


def _stored(patterns: DataFrame, name: str) -> SortedStore:
    """A store of the distinct patterns of a staged table."""
    store = SortedStore(new_path(patterns.sparkSession, "patterns"), name, shard_bits(patterns.count(), 4_000_000), {})
    shard = F.shiftrightunsigned("pattern", 64 - store.bits) if store.bits else F.lit(0).cast("long")
    patterns.select("pattern", shard.alias("shard")).groupBy("shard").applyInArrow(_write(store), "shard long").collect()
    return store


def confident_patterns(documents: DataFrame, least_seeds: int = LEAST_SEEDS, confident: float = CONFIDENT, rounds: int = ROUNDS) -> DataFrame:
    """Patterns (64-bit hashes of the words before) and their confidence after the last round; those of at least `confident`."""
    texts = documents.select("text")
    seeds = texts.mapInArrow(_seed_edges, "pattern long, instance long").distinct()
    candidates = stage(seeds.groupBy("pattern").count().where(F.col("count") >= least_seeds).select("pattern"), "candidates")
    edges = texts.mapInArrow(_graph_edges(_stored(candidates, "candidate")), "pattern long, instance long, seed boolean, n long")
    edges = stage(edges.groupBy("pattern", "instance", "seed").agg(F.sum("n").alias("n")), "graph")
    totals = stage(edges.groupBy("pattern").agg(F.sum("n").alias("total")), "totals")
    real = edges.where("instance is not null")
    scores = real.where("seed").select("instance").distinct().withColumn("score", F.lit(1.0))
    patterns = None
    for _ in range(rounds):
        given = real.join(scores, "instance").groupBy("pattern").agg(F.sum(F.col("score") * F.col("n")).alias("mass"))
        patterns = stage(totals.join(given, "pattern").select("pattern", F.least(F.lit(1.0), F.col("mass") / F.col("total")).alias("confidence")), "patterns")
        open_share = F.exp(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("confidence")))))
        found = real.where("not seed").join(patterns, "pattern").groupBy("instance").agg((1 - open_share).alias("score"))
        seeded = real.where("seed").select("instance").distinct()
        scores = stage(found.join(seeded, "instance", "left_anti").union(seeded.withColumn("score", F.lit(1.0))), "scores")
    return patterns.where(F.col("confidence") >= confident)


def _all_spans(texts: list[str], store: SortedStore) -> list[list[tuple[int, int, int]]]:
    """Base spans and those that confident patterns name."""
    spans = [base_spans(t) for t in texts]
    words = _Words(texts)
    maybe = np.flatnonzero(words.identifiers())
    maybe = maybe[~words.covered(spans)[maybe]]
    hit = np.zeros(len(maybe), bool)
    for k in (0, 1):
        names, back = np.unique(words.patterns[k, maybe], return_inverse=True)
        hit |= words.has[k, maybe] & store.find(names)[0][back]
    for at in maybe[hit].tolist():
        text, low, high = int(words.text[at]), int(words.low[at]), int(words.high[at])
        word = texts[text][low:high]
        low += len(word) - len(word.lstrip(_EDGES))
        high -= len(word) - len(word.rstrip(_EDGES))
        if low < high:
            spans[text].append((low, 4, high))
    return [sorted(s) for s in spans]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(documents: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans."""
    store = _stored(stage(confident_patterns(documents).select("pattern"), "confident"), "confident")

    def run(batches):
        for rows, _, _ in tokens.text_chunks(batches):
            spans = _all_spans(_texts(rows.column(1)), store)
            counts = [[sum(s[1] == k for s in held) for held in spans] for k in range(len(KINDS))]
            digests = [hashlib.sha256(_listed([s for s in held if s[1] < 4]).encode()).hexdigest() for held in spans]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([_listed(s) for s in spans], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with every span of their texts replaced by its kind in angle brackets; of overlapping spans the first counts."""
    store = _stored(stage(confident_patterns(documents).select("pattern"), "confident"), "confident")
    place = documents.columns.index("text")

    def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for begin, kind, end in spans:
            if begin >= at:
                out += [text[at:begin], f"<{KINDS[kind]}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches):
        for rows, _, _ in tokens.text_chunks(batches):
            texts = _texts(rows.column(place))
            done = pa.array([masked(t, s) for t, s in zip(texts, _all_spans(texts, store))], pa.string())
            missing = rows.column(place).is_null()
            columns = list(rows.columns)
            columns[place] = pc.if_else(missing, pa.scalar(None, pa.string()), done)
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    return documents.mapInArrow(run, documents.schema)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
