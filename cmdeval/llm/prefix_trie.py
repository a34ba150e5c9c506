"""Operator 12: trie of conversation prefixes, by composable monoid fingerprints.

Every conversation ``c`` is rebuilt: the first ``h`` turns of its base (the
conversation ``c - c % 5``), then its own turns after its first ``h``, with ``h``
the CRC-32 of decimal ``c`` modulo 9. A node is a distinct prefix of rebuilt turns.

Fingerprints. The turns of a prefix make the product ``sum of x_i * r ** i`` in
four prime fields, with ``x_i`` from the turn's digest; with their lengths such
products form a monoid. One pass over range-sorted turns gives the products of all
original prefixes: local ones within a range, composed with what stands before in
the few conversations that cross ranges. A rebuilt prefix is then ``head`` (product
of the base's first turns) composed with ``own[k] - own[h]``, moved by a power of
``r``: no rebuilt text or turn list is ever made, a row holds only numbers.

Verification. A row keeps a reference to the stored turn that it ends with. Rows
of one fingerprint must agree in the hashes of that turn and in the parent's
fingerprint, and stored turns of the same hashes must have the same role and text:
by induction the whole prefixes are then equal. Where anything collides, all is
done again with another seed.

Subtree sums need no walk from level to level. A node belongs to its smallest
member; along a conversation the nodes it owns are its last ones. So the subtree
of a node holds all that its members own, but for what its smallest member owns
above the node: a sum over members less a running total.

Scale. A conversation with a third of all turns is cut by the range sort; a node
with a third of all conversations is pre-aggregated; the ids that end at a node
are joined to pieces where they are sorted and hashed as a stream.

Null roles and texts are empty. Turns of one number are ordered by role, then by the
SHA-256 of the text; a null number comes first; a repeated row is a turn of its
own. Rows without a conversation id are of no conversation. An empty table gives no
node. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, prefix_sums, ship

#: Rebuilding: bases are every fifth conversation, at most this many turns come from one.
STEP, HEADS = 5, 8
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
LANES = range(len(PRIMES))
#: Ids of one piece of a list of conversations.
PIECE = 1 << 14
NODE = ["depth", "f1", "f2"]


def bases(seed: int) -> list[int]:
    rng = random.Random(seed)
    return [rng.randrange(1 << 24, p - 1) for p in PRIMES]


def powers(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """``base ** exponents`` modulo a prime below 2 ** 31."""
    p, out, square = np.uint64(prime), np.ones(len(exponents), dtype=np.uint64), np.uint64(base)
    left = exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * square % p, out)
        square = square * square % p
        left = left >> np.uint64(1)
    return out


def head_turns(conv: Column) -> Column:
    """How many turns of its base a conversation begins with."""
    return (F.crc32(conv.cast("string").cast("binary")) % (HEADS + 1)).cast("bigint")


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, seed: int) -> DataFrame:
    """Each turn with two hashes of its role and text."""
    kept = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    return kept.select("*", F.xxhash64(F.lit(seed), "role", "text").alias("x1"),
                       F.xxhash64(F.lit(~seed), "text", "role").alias("x2"))


def _stored(turns: DataFrame) -> DataFrame:
    """What is kept of each turn: its place in the order, its hashes and its size."""
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    return materialise(turns.select("conv", "turn", "role", digest, F.octet_length("text").cast("bigint").alias("n_bytes"),
                                    "row", "x1", "x2"), "trie-turns")


def _differ(classes: DataFrame, keys: list[str], facts: list[str]) -> bool:
    """Whether rows of one class differ in a fact."""
    ends = classes.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in facts for f, n in ((F.min, "lo"), (F.max, "hi"))])
    return not ends.where(" OR ".join(f"lo_{c} <> hi_{c}" for c in facts)).isEmpty()


def _prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """(conv, pos, n_bytes, x1, x2, q0.., t0..): for each turn its place from 1, the product of the turns up
    to it, and its own term of that product."""
    names = ["conv", "n_bytes", "x1", "x2"]
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("row")]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("range"), *names)
    r = bases(seed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, carry = None, 0, [np.uint64(0)] * len(PRIMES)
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(1).to_numpy(zero_copy_only=False)
            x = [b.column(3 + k // 2).to_numpy(zero_copy_only=False).view(np.uint64) for k in LANES]
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.append(first, len(conv)))
            goes_on = conv[0] == last
            j = np.arange(1, len(conv) + 1) - np.repeat(first, sizes)
            if goes_on:
                j[:sizes[0]] += place
            out = [b.column(0), b.column(1), pa.array(j), *b.columns[2:]]
            sums, terms = [], []
            for k in LANES:
                p = np.uint64(PRIMES[k])
                t = x[k] % p * powers(r[k], j, PRIMES[k]) % p
                total = np.cumsum(t, dtype=np.uint64)  # a batch is far below 2 ** 32 rows
                q = total - np.repeat(total[first] - t[first], sizes)
                if goes_on:
                    q[:sizes[0]] += carry[k]
                q %= p
                sums.append(pa.array(q.astype(np.int64)))
                terms.append(pa.array(t.astype(np.int64)))
                carry[k] = q[-1]
            last, place = conv[-1], int(j[-1])
            yield pa.RecordBatch.from_arrays([*out, *sums, *terms], schema_names)

    schema = ("range int, conv bigint, j bigint, n_bytes bigint, x1 bigint, x2 bigint, "
              + ", ".join(f"{c}{k} bigint" for c in "qt" for k in LANES))
    schema_names = [f.strip().split(" ")[0] for f in schema.split(",")]
    scanned = materialise(ranged.mapInArrow(scan, schema), "trie-scan")

    # What stands before a range in a conversation that began in an earlier one: a row a range at most.
    ends = scanned.groupBy("range").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi"))
    crossing = (ends.select("range", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("conv"))
                .groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv"))
    parts = (scanned.join(F.broadcast(crossing), "conv", "left_semi").groupBy("conv", "range")
             .agg(F.max(F.struct("j", *[f"q{k}" for k in LANES])).alias("x")).select("conv", "range", "x.*"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # rows: ranges
    parts = parts.withColumn("off", F.coalesce(F.sum("j").over(before), F.lit(0)))

    @F.pandas_udf("array<bigint>")
    def shift(off):
        import pandas as pd
        lanes = [powers(r[k], off.to_numpy(), PRIMES[k]).astype(np.int64) for k in LANES]
        return pd.Series(list(np.stack(lanes, axis=1)))

    parts = parts.withColumn("f", shift("off"))
    moved = [(F.col("f")[k] * F.col(f"q{k}") % PRIMES[k]) for k in LANES]
    parts = parts.select("conv", "range", "off", "f", *[
        (F.sum(m).over(before) % PRIMES[k]).alias(f"o{k}") for k, m in zip(LANES, moved)]).where("off > 0")
    placed = scanned.join(F.broadcast(parts), ["conv", "range"], "left")
    factor = [F.coalesce(F.col("f")[k], F.lit(1)) for k in LANES]
    return placed.select(
        "conv", (F.col("j") + F.coalesce("off", F.lit(0))).alias("pos"), "n_bytes", "x1", "x2",
        *[((F.coalesce(f"o{k}", F.lit(0)) + factor[k] * F.col(f"q{k}")) % PRIMES[k]).alias(f"q{k}") for k in LANES],
        *[(factor[k] * F.col(f"t{k}") % PRIMES[k]).alias(f"t{k}") for k in LANES])


def _rebuilt(prefixes: DataFrame, seed: int) -> DataFrame:
    """(conv, depth, f1, f2, g1, g2, x1, x2, n_bytes, ref_conv, ref_pos, is_end): all prefixes of rebuilt
    conversations; f names the prefix, g its parent, ref the stored turn that it ends with."""
    turn = F.struct("pos", "n_bytes", "x1", "x2", *[f"{c}{k}" for c in "qt" for k in LANES])
    own = prefixes.groupBy("conv").agg(
        F.max("pos").alias("n"), *[F.max(F.when(F.col("pos") == head_turns(F.col("conv")), F.col(f"q{k}"))).alias(f"own{k}")
                                   for k in LANES])
    heads = (prefixes.where(f"pos <= {HEADS} AND conv % {STEP} = 0").groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(turn)).alias("head")))
    plan = own.withColumn("h", head_turns(F.col("conv"))).withColumn("base", F.expr(f"conv - conv % {STEP}"))
    plan = (plan.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("h").cast("int")))
            .withColumn("kept", F.size("head").cast("bigint"))
            .withColumn("size", F.col("kept") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    plan = materialise(plan, "trie-plan")

    def row(q: list[Column], t: list[Column], depth: Column, size: Column, *rest: Column) -> list[Column]:
        up = [(q[k] - t[k] + PRIMES[k]) % PRIMES[k] for k in LANES]
        two = [(a[0] * (1 << 31) + a[1], a[2] * (1 << 31) + a[3]) for a in (q, up)]
        names = [("f1", "f2"), ("g1", "g2")]
        return [F.col("conv"), depth.alias("depth"), *[c.alias(n) for cs, ns in zip(two, names) for c, n in zip(cs, ns)],
                *rest, (depth == size).alias("is_end")]

    first = plan.select("conv", "base", "size", F.explode("head").alias("e"))
    of_head = first.select(*row([F.col(f"e.q{k}") for k in LANES], [F.col(f"e.t{k}") for k in LANES], F.col("e.pos"), F.col("size"),
                                F.col("e.x1").alias("x1"), F.col("e.x2").alias("x2"), F.col("e.n_bytes").alias("n_bytes"),
                                F.col("base").alias("ref_conv"), F.col("e.pos").alias("ref_pos")))
    r = bases(seed)
    back = [F.array(*[F.lit(pow(pow(r[k], -1, PRIMES[k]), d, PRIMES[k])) for d in range(HEADS + 1)]) for k in LANES]
    moved = F.col("h") - F.col("kept")
    longer = plan.where("n > h").select("conv", "h", "kept", "size", *[F.coalesce(f"own{k}", F.lit(0)).alias(f"own{k}") for k in LANES],
                                        *[F.when(F.col("kept") > 0, F.element_at("head", -1)[f"q{k}"]).otherwise(0).alias(f"base{k}")
                                          for k in LANES])
    joined = prefixes.join(longer, "conv").where("pos > h")
    scale = [F.element_at(back[k], (moved + 1).cast("int")) for k in LANES]
    q = [(F.col(f"base{k}") + (F.col(f"q{k}") - F.col(f"own{k}") + PRIMES[k]) % PRIMES[k] * scale[k]) % PRIMES[k] for k in LANES]
    t = [F.col(f"t{k}") * scale[k] % PRIMES[k] for k in LANES]
    of_own = joined.select(*row(q, t, F.col("pos") - moved, F.col("size"), F.col("x1"), F.col("x2"), F.col("n_bytes"),
                                F.col("conv").alias("ref_conv"), F.col("pos").alias("ref_pos")))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = plan.select("conv", zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), none.alias("g1"), none.alias("g2"),
                       none.alias("x1"), none.alias("x2"), zero.alias("n_bytes"), none.alias("ref_conv"), none.alias("ref_pos"),
                       (F.col("size") == 0).alias("is_end"))
    return materialise(root.unionByName(of_head).unionByName(of_own), "trie-rows")


def _end_hashes(rows: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of the nodes at which conversations end."""
    keys = [*NODE, "conv"]
    ends = rows.where("is_end").select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    names = [*keys, "piece"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of ids of one node, each with its first id."""
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not len(cols[0]):
                continue
            new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)])
            first = np.flatnonzero(new)
            first = np.unique(np.concatenate([first, np.arange(0, len(new), PIECE)]))
            stop = np.append(first[1:], len(new))
            texts = [str(i) for i in cols[3].tolist()]
            pieces = [",".join(texts[lo:hi]) for lo, hi in zip(first, stop)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[first]) for c in cols], pa.array(pieces, pa.string())], names)

    pieces = ends.mapInArrow(cut, "depth bigint, f1 bigint, f2 bigint, conv bigint, piece string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for b in batches:
            done = []
            for *key, _, piece in zip(*[c.to_pylist() for c in b.columns]):
                if key == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(piece.encode())
            yield packed(done)
        if node is not None:
            yield packed([(*node, sha.hexdigest())])

    def packed(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                          [*NODE, "ends_sha256"])

    # Few rows a node, each a piece of its list: they are read one after another, never held together.
    return (pieces.repartition(*NODE).sortWithinPartitions(*keys)
            .mapInArrow(hashed, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string"))


def build(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """A row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and the stored turn that its prefix ends with: ref_conv_id, ref_place."""
    ship(conversations.sparkSession)
    seed = 1
    while True:
        turns = _turns(conversations, conv, turn, role, text, seed)
        if not _differ(turns, ["x1", "x2"], ["text", "role"]):
            rows = _rebuilt(_prefixes(_stored(turns), seed), seed)
            facts = ["x1", "x2", "g1", "g2"]
            nodes = materialise(rows.groupBy(*NODE).agg(
                F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.max("n_bytes").alias("n_bytes"),
                *[f(c).alias(f"{n}_{c}") for c in facts for f, n in ((F.min, "lo"), (F.max, "hi"))],
                F.min("ref_conv").alias("ref_conv_id"), F.min_by("ref_pos", "ref_conv").alias("ref_place")), "trie-nodes")
            if nodes.where(" OR ".join(f"lo_{c} <> hi_{c}" for c in facts)).isEmpty():
                break
        seed += 1
    nodes = nodes.select(*NODE, "n_convs", "conv_id", F.col("lo_g1").alias("g1"), F.col("lo_g2").alias("g2"), "ref_conv_id",
                         "ref_place", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
    summed = materialise(prefix_sums(nodes, [F.col("conv_id"), F.col("depth")], {"saved": "above"}, "trie-owned"), "trie-sums")
    # Running totals grow with the id of the owner: the least of a node's members is that of its smallest one.
    owned = summed.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum("leaf").alias("leaves"), F.sum("saved").alias("owned"), F.min("above").alias("from"))
    below = rows.select(*NODE, "conv").join(owned, "conv").groupBy(*NODE).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("owned").alias("owned"), F.min("from").alias("from"))
    parents = summed.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"),
                            F.col("conv_id").alias("parent_conv_id"))
    out = (summed.join(below, NODE).join(_end_hashes(rows), NODE, "left")
           .join(parents, ["depth", "g1", "g2"], "left"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("owned") - (F.col("above") - F.col("from"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "ref_conv_id", "ref_place")
