"""Trie of conversation prefixes by whole-sequence collapse: nothing is built node by node.

A conversation's turns stand in order of `turn` (null first; equal turns by role, then text); a null role or text is empty. A prefix
of d turns is named by d and two 64-bit exclusive ors of hashes that cover place, role and text of each of its turns, so all names
come from running aggregates.

1. `rebuilt` makes the conversations to be studied (see there).
2. Collapse: equal conversations become one weighted sequence, named by its smallest conv_id, with the list of those that end there.
3. Leaves: a sequence that is a proper prefix of another goes by an anti-join of sequences with the prefixes of longer ones.
4. Weighted prefixes are summed to nodes: members, smallest member, leaves below.
5. Sums over subtrees: a node belongs to the smallest leaf below it, so a leaf owns the lower end of its path. A node's subtree then
   holds all that the leaves below it own, but for what its own leaf owns above it: one aggregate and one running sum. No node
   meets its ancestors one by one, so long conversations cost what they hold.

No step puts a conversation, a group of copies or a node's members into one task: places come from ranges of the sorted rows
(`prefix.ranked`), running values are cut into stretches of `STRETCH` turns, and lists of ends are joined from sorted blocks. Only the
digest of one list, sequential by nature, is one task's stream; it reads text blocks of at most `BLOCK` ids and holds one.

Defined cases: rows without conv_id take no part; turnless conversations exist only by rebuilding and end at the root; repeated rows
are turns of their own; an empty table gives no node (not even the root); other columns are ignored; texts of any length are
hashed whole and never shuffled after the first sort.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from salescube.operators.prefix import ranked
from salescube.sources.scratch import stage

GROUP, SPREAD = 5, 9
STRETCH = 1 << 12
BLOCK = 1 << 13
_NAME = ["depth", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (place from 1), t1 and t2 (hashes of role and text), size (UTF-8 bytes of the text)."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kept = ["conv_id", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit("again"), "text", "role").alias("t2"),
            F.octet_length("text").cast("long").alias("size")]
    return ranked(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "n", kept)


def rebuilt(own: DataFrame, group: int = GROUP, spread: int = SPREAD) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of a neighbour: the first h turns of conversation c - c % group (all, if it has fewer), then c's own
    turns after its first h; h = crc32(c in decimal) % spread. Returns (conv_id, length) and their turns (conv_id, n, t1, t2, size)."""
    sizes = own.groupBy("conv_id").agg(F.max("n").alias("own"))
    heads = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    plan = sizes.select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).alias("h"),
    ).join(heads, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("head"),
        (F.least("h", F.coalesce("there", F.lit(0))) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    first = own.where(F.col("n") < spread).withColumnRenamed("conv_id", "base")
    taken = plan.join(first, "base").where("n <= head").select("conv_id", "n", "t1", "t2", "size")
    kept = own.join(plan, "conv_id").where("n > h").select("conv_id", (F.col("head") + F.col("n") - F.col("h")).alias("n"), "t1", "t2", "size")
    return plan.select("conv_id", "length"), taken.unionByName(kept)


def _running(rows: DataFrame, key: str, place: str, values: dict[str, tuple[Column, str]]) -> DataFrame:
    """Running aggregates ('sum' or 'bit_xor') along `place` (whole numbers) inside each key, this row included, in stretches."""
    call = {"sum": F.sum, "bit_xor": F.bit_xor}
    cut = rows.withColumns({f"__{n}": c for n, (c, _) in values.items()} | {"__s": F.floor(F.col(place) / STRETCH)})
    inside = Window.partitionBy(key, "__s").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    here = cut.withColumns({n: call[how](f"__{n}").over(inside) for n, (_, how) in values.items()})
    before = Window.partitionBy(key).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    longer = cut.groupBy(key, "__s").agg(*[call[how](f"__{n}").alias(f"__{n}") for n, (_, how) in values.items()])
    offsets = longer.select(key, "__s", *[call[how](f"__{n}").over(before).alias(f"__o_{n}") for n, (_, how) in values.items()])
    offsets = offsets.where(" OR ".join(f"__o_{n} IS NOT NULL" for n in values))
    joined = here.join(offsets, [key, "__s"], "left")
    added = {n: F.coalesce(F.col(f"__o_{n}"), F.lit(0)) for n in values}
    return joined.select(*rows.columns, *[(F.col(n) + added[n] if how == "sum" else F.col(n).bitwiseXOR(added[n])).alias(n) for n, (_, how) in values.items()])


def prefixes(rows: DataFrame) -> DataFrame:
    """Every prefix of every conversation but the empty one: conv_id, depth, p1, p2, q1, q2 (of the prefix before), size."""
    rows = rows.select("conv_id", F.col("n").alias("depth"), F.xxhash64(F.lit(1), "n", "t1", "t2").alias("x1"),
                       F.xxhash64(F.lit(2), "n", "t2", "t1").alias("x2"), "size")
    named = _running(rows, "conv_id", "depth", {"p1": (F.col("x1"), "bit_xor"), "p2": (F.col("x2"), "bit_xor")})
    return named.select("conv_id", *_NAME, F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "size")


def _end_blocks(batches):
    """Runs of equal names in sorted (depth, p1, p2, conv_id) rows, as blocks of ids in text."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            columns = [batch.column(i).slice(at, BLOCK).to_pylist() for i in range(4)]
            names = list(zip(*columns[:3]))
            begin = [i for i in range(len(names)) if not i or names[i] != names[i - 1]] + [len(names)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([columns[c][i] for i in begin[:-1]], pa.int64()) for c in range(4)),
                 pa.array([",".join(map(str, columns[3][i:j])) for i, j in zip(begin, begin[1:])], pa.string())],
                names=[*_NAME, "first", "ids"])


def _end_digests(batches):
    """One digest per name, over its blocks in order."""
    name, digest = None, None
    for batch in batches:
        done = []
        for *now, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if now == name:
                digest.update(b",")
            else:
                if name is not None:
                    done.append((*name, digest.hexdigest()))
                name, digest = now, hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield _digest_rows(done)
    if name is not None:
        yield _digest_rows([(*name, digest.hexdigest())])


def _digest_rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*_NAME, "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256: digest of the comma-joined conv_ids that end there, ascending."""
    order = [*_NAME, "conv_id"]
    blocks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _end_blocks, "depth long, p1 long, p2 long, first long, ids string")
    return blocks.repartition("p1", "p2").sortWithinPartitions(*_NAME, "first").mapInArrow(
        _end_digests, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(conversations: DataFrame, group: int = GROUP, spread: int = SPREAD) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_ends."""
    own = stage(turns(conversations), "turns")
    plan, rows = rebuilt(own, group, spread)
    plan = stage(plan, "lengths")
    steps = stage(prefixes(rows), "steps")
    none = F.lit(0).cast("long")
    whole = steps.select("conv_id", *_NAME).join(plan.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    ends = stage(whole.unionByName(plan.where("length = 0").select("conv_id", *[none.alias(c) for c in _NAME])), "ends")

    sequences = stage(ends.groupBy(*_NAME).agg(F.count("*").alias("weight"), F.min("conv_id").alias("rep")), "sequences")
    reps = sequences.select(F.col("rep").alias("conv_id"), "weight", F.col("depth").alias("length"))
    roots = reps.select("conv_id", *[none.alias(c) for c in (*_NAME, "q1", "q2", "size")], "weight", "length")
    paths = stage(steps.join(reps, "conv_id").unionByName(roots), "paths")
    longer = paths.where("depth < length").select(*_NAME).distinct()
    leaves = sequences.join(longer, _NAME, "left_anti").select(F.col("rep").alias("conv_id"), F.lit(1).cast("long").alias("leaf"))
    marked = paths.join(stage(leaves, "leaves"), "conv_id", "left")
    nodes = stage(marked.groupBy(*_NAME).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("size").alias("size"),
    ).withColumn("saved", (F.col("n_convs") - 1) * F.col("size")), "nodes")

    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("saved").alias("total"))
    below = marked.where("leaf = 1").join(owned, "conv_id").groupBy(*_NAME).agg(F.sum("total").alias("below"))
    upper = _running(nodes.select(*_NAME, "owner", "saved"), "owner", "depth", {"upto": (F.col("saved"), "sum")})
    saved = upper.join(below, _NAME).select(*_NAME, (F.col("below") - F.col("upto") + F.col("saved")).alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    lists = ends_digests(ends).join(sequences.select(*_NAME, F.col("weight").alias("n_ends")), _NAME)
    return (
        nodes.join(children, _NAME, "left").join(saved, _NAME).join(lists, _NAME, "left").join(parents, ["depth", "q1", "q2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), F.coalesce("n_ends", F.lit(0)).alias("n_ends"))
    )


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    nodes = trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
