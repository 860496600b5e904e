"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and connected components.

A text is lower-cased (A-Z) and split into words at ASCII white space; its set is its distinct shingles of `words` words, hashed
to 64 bits (fewer words: the whole sequence as one shingle; no words: the empty set, linked with nothing). Two documents are
linked if their sets' Jaccard similarity is at least `percent` / 100, decided on the full sets in whole numbers.

1. Documents with equal sets form one class (128-bit sum of their hashes); all further work is on classes.
2. SuperMinHash: every shingle draws its ranks 0, 1, 2, ... for the slots of the signature as one random permutation, so a slot's
   values are spread better than independent draws, and a document stops once no rank to come can lower a slot.
3. Bands of four slots are bucket keys. A pair at 0.8 shares none of 32 bands with probability 5e-8.
4. Every member of a bucket is verified against the bucket's smallest class. Components of these links settle most buckets.
5. In buckets that still hold several components every pair across components is a possible link. What each member lacks of the
   smallest class and adds to it, as counts and 512 bits each, bounds from above what two members share. Pairs whose bound
   reaches the similarity are verified on the full sets; the bound is exact, so no link is lost.
6. The components of all links are found by star contraction (`components`).

No step gathers a bucket or a component in one task. Step 5 compares bits of members of one bucket in different components; a
bucket that holds very many classes which link with nothing in it is the worst case.

Defined cases: null text is empty; empty sets stay alone; a row without doc_id takes part as a copy in its class but names none
(component_id is null, and such rows are kept, if no row of the class has an id); repeated rows each come back; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens
from salescube.llm.components import connected
from salescube.sources.scratch import stage

SLOTS, BAND = 128, 4
_STEP = np.uint64(0xA24BAED4963EE407)
_STEPS = np.arange(1, 1 << 10, dtype=np.uint64) * _STEP
_GROUP = 1 << 15


def superminhash(hashes: np.ndarray, at: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """One row of `slots` values per set; a slot no element reaches stays infinite (empty sets only)."""
    out = np.full((len(at) - 1, slots), np.inf)
    flat = out.reshape(-1)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + _GROUP, side="right")) - 1)
        elements = hashes[at[first]:at[last]]
        owner = np.repeat(np.arange(first, last), np.diff(at[first:last + 1]))
        order = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
        live = np.arange(len(elements))
        for j in range(slots):
            if not len(live):
                break
            drawn = tokens.mix(elements[live] + _STEPS[j])
            place = j + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
            slot = order[live, place]
            order[live, place] = order[live, j]
            np.minimum.at(flat, owner[live] * slots + slot, j + (drawn >> np.uint64(32)) * 2.0 ** -32)
            live = live[out[first:last].max(axis=1)[owner[live] - first] > j + 1]
        first = last
    return out


def band_keys(signatures: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ."""
    rows, slots = signatures.shape
    bits = signatures.view(np.uint64).reshape(rows, slots // band, band)
    weights = tokens.mix(np.arange(1, band + 1, dtype=np.uint64))
    return tokens.mix((bits * weights).sum(axis=2) + tokens.mix(np.arange(slots // band, dtype=np.uint64) + np.uint64(97)))


def _sets(raw: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    raw = tokens.lower(raw)
    starts, ends, first = tokens.word_spans(raw, offs)
    return tokens.shingle_sets(tokens.word_hashes(raw, starts, ends), first, words)


def _class_names(hashes: np.ndarray, at: np.ndarray) -> pa.Array:
    """16 bytes per set that depend on its elements alone."""
    both = np.zeros((len(at) - 1, 2), np.uint64)
    for k, values in enumerate((hashes, tokens.mix(hashes ^ _STEP))):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        both[:, k] = sums[at[1:]] - sums[at[:-1]]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(both), [None, pa.py_buffer(both)]).cast(pa.binary())


def _features(words: int):
    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            hashes, at = _sets(raw, offs, words)
            keys = tokens.signed(band_keys(superminhash(hashes, at)))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(at)), _class_names(hashes, at), bands], names=["doc_id", "n_shingles", "cls", "bands"])
    return run


def _full_sets(words: int):
    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            hashes, at = _sets(raw, offs, words)
            yield pa.RecordBatch.from_arrays(
                [_class_names(hashes, at), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens.signed(hashes)))], names=["cls", "shingles"])
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    left = sets.select(F.col("cls").alias("u"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("cls").alias("v"), F.col("shingles").alias("right_set"))
    both = pairs.join(left, "u").join(right, "v").select(
        "u", "v", F.size(F.array_intersect("left_set", "right_set")).alias("shared"), (F.size("left_set") + F.size("right_set")).alias("total"))
    return both.where(f"100 * shared >= {percent} * (total - shared)").select("u", "v").distinct()


def _bits(name: str, sets: str) -> list[F.Column]:
    """512 bits, in eight columns, of the elements of an array of hashes."""
    return [F.expr(f"aggregate(filter({sets}, x -> (x & 7) = {k}), 0L, (bits, x) -> bits | shiftleft(1L, cast((x >> 3) & 63 as int)))").alias(f"{name}{k}")
            for k in range(8)]


def _total_bits(operation: str, name: str) -> str:
    return " + ".join(f"bit_count(one.{name}{k} {operation} two.{name}{k})" for k in range(8))


#: Upper bound of what two members of a bucket share, from how each differs from the bucket's hub. Of the hub they share at most
#: what neither lacks (set bits count lacking elements or fewer); beyond it, an element both have sets the same bit in both.
_MOST_SHARED = (
    f"least(one.n, two.n, one.hub_n - greatest(one.lacks, two.lacks, {_total_bits('|', 'lack')}) + "
    f"least(one.adds, two.adds, {_total_bits('&', 'add')} + least(one.adds_again, two.adds_again)))")


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs (u, v): how many elements of u the set v lacks, how many it adds, and the bits of both."""
    left = sets.select(F.col("cls").alias("u"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("cls").alias("v"), F.col("shingles").alias("right_set"))
    both = pairs.join(left, "u").join(right, "v").select(
        "u", "v", F.array_except("left_set", "right_set").alias("lacking"), F.array_except("right_set", "left_set").alias("added"))
    found = both.select("u", "v", F.size("lacking").alias("lacks"), F.size("added").alias("adds"), *_bits("lack", "lacking"), *_bits("add", "added"))
    return found.withColumn("adds_again", F.expr("adds - (" + " + ".join(f"bit_count(add{k})" for k in range(8)) + ")")).dropDuplicates(["u", "v"])


def groups(documents: DataFrame, words: int, percent: int = 80) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest doc_id of the group), kept."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = stage(texts.mapInArrow(_features(words), "doc_id long, n_shingles long, cls binary, bands array<long>"), "signatures")
    classes = stage(features.where("n_shingles > 0").groupBy("cls").agg(
        F.min("doc_id").alias("named"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")

    shared = classes.select(F.explode("bands").alias("key")).groupBy("key").count().where("count > 1").select("key")
    members = stage(classes.select("cls", "n", F.explode("bands").alias("key")).join(shared, "key", "left_semi"), "members")
    hubs = members.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("hub"))
    pairs = members.join(hubs, "key").where(
        f"cls <> hub.cls and 100 * least(n, hub.n) >= {percent} * greatest(n, hub.n)").select(F.col("hub.cls").alias("u"), F.col("cls").alias("v")).distinct()

    bucketed = members.select("cls").distinct()
    wanted = classes.join(bucketed, "cls", "left_semi").select(F.col("named").alias("doc_id"))
    sets = stage(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_full_sets(words), "cls binary, shingles array<long>").join(
        bucketed, "cls", "left_semi"), "sets")
    links = stage(_links(pairs, sets, percent), "links")
    found = connected(links)

    labelled = members.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("component", "cls")).drop("component")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("cls", "n")).alias("hub")).where("low <> high")
    open_members = stage(labelled.join(mixed.select("key", F.col("hub.cls").alias("hub"), F.col("hub.n").alias("hub_n")), "key"), "open")
    against = _differences(open_members.where("cls <> hub").select(F.col("hub").alias("u"), F.col("cls").alias("v")).distinct(), sets)
    able = open_members.join(against.withColumnsRenamed({"u": "hub", "v": "cls"}), ["hub", "cls"], "left").na.fill(0)
    able = stage(able.repartition("key"), "able")
    one, two = able.alias("one"), able.alias("two")
    across = one.join(two, F.expr(
        f"one.key = two.key and one.cls < two.cls and one.label <> two.label and 100 * {_MOST_SHARED} >= {percent} * (one.n + two.n - {_MOST_SHARED})")).select(
        F.col("one.cls").alias("u"), F.col("two.cls").alias("v")).distinct()
    more = stage(_links(across, sets, percent), "links")
    if not more.isEmpty():
        found = connected(links.union(more))

    grouped = classes.select("cls", "named").join(found.withColumnRenamed("node", "cls"), "cls")
    smallest = grouped.groupBy("component").agg(F.min("named").alias("smallest"))
    renamed = grouped.join(smallest, "component").select("cls", "smallest")
    named = classes.select("cls", "named").join(renamed, "cls", "left").select("cls", F.coalesce("smallest", "named").alias("component"))
    out = features.select("doc_id", "n_shingles", "cls").join(named, "cls", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group (the one with the smallest doc_id), with its columns; of repeated rows one stays. Rows without
    doc_id stay.
    """
    kept = groups(documents, words, percent).where("kept").select("doc_id").distinct()
    named = documents.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(documents.where("doc_id is null")).select(*(f"`{c}`" for c in documents.columns))


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents, on two-word shingles."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
