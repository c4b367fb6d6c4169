"""Near duplicates by HyperMinHash.

A document's word shingles are hashed once.  The first bits of a hash choose
one of 128 registers; a register keeps its smallest hash, compressed to the
count of leading zeros and ten bits of mantissa.  Runs of registers (bands)
bring candidates together, the corrected register agreement estimates their
similarity, and pairs near the threshold or above are confirmed on the full
shingle sets.

No bucket is expanded into all its pairs.  Equal sets are one node.  Every node
is first confirmed against the likeliest of the hubs of its buckets; buckets
that then lie in one component are done.  The others are compared in
blocks of bounded size, inside tasks, leaving out what is connected already.
There a second, sharper estimate (the parities of hashed shingles tell the size
of the difference of two sets) leaves only pairs at the threshold or above to
be confirmed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.hashing import window_hashes, word_hashes
from tidemark.llm.words import content_id, or_empty
from tidemark.llm.worker import small_batches
from tidemark.session import cut_lineage

REGISTER_BITS, MANTISSA = 7, 10
REGISTERS = 1 << REGISTER_BITS
#: Bands of five registers: a pair at 85 % shares none of them once in two million times.
ROWS, BANDS = 5, REGISTERS // 5
#: Bits of the parity sketch.
PARITIES = 4096
#: Nodes compared with each other in one step (a block of a bucket).
BLOCK = 256
#: Standard deviations below the threshold at which a pair is still confirmed.
MARGIN = 4.5
#: Node ids broadcast at most to pick documents out of a scan; beyond it both sides are shuffled.
BROADCAST_NODES = 1_000_000


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words are one shingle, none are none."""
    # Bytes are lower-cased and split by ASCII rules only, as asked for.
    hashes = word_hashes(text.encode("utf-8", "surrogatepass").lower().split())
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(size, len(hashes))))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of sorted hashes: 0 if empty, else leading zeros + 1 and the mantissa bits."""
    registers = np.zeros(REGISTERS, np.uint16)
    shift = np.uint64(64 - REGISTER_BITS)
    # Sorted hashes come register by register, smallest first.
    which, first = np.unique(hashes >> shift, return_index=True)
    rest = hashes[first] << np.uint64(REGISTER_BITS)
    zeros = np.minimum(64 - np.frexp(rest.astype(np.float64))[1], 64 - REGISTER_BITS).astype(np.uint64)
    fraction = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    registers[which.astype(np.int64)] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | fraction).astype(np.uint16)
    return registers


def agreement(a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of sketches (last axis: registers) and the registers it rests on.

    Two different smallest hashes share a compressed register by chance; the
    expected share (cells of relative width 2**-MANTISSA under two exponential
    minima) is taken out.
    """
    used = np.maximum(((a != 0) | (b != 0)).sum(-1), 1)
    share = ((a == b) & (a != 0)).sum(-1) / used
    chance = 0.7213 * 2.0**-MANTISSA * count_a * count_b / np.square(count_a + count_b)
    return np.maximum(share - chance, 0) / (1 - chance), used


def first_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first band that two sketches share; BANDS if there is none."""
    same = (a == b)[..., : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(-1)
    same &= (a != 0)[..., : BANDS * ROWS].reshape(-1, BANDS, ROWS).any(-1)
    return np.where(same.any(-1), same.argmax(-1), BANDS)


def parity(hashes: np.ndarray) -> np.ndarray:
    """One bit per cell: whether an odd number of shingles falls into it."""
    return np.packbits(np.bincount((hashes & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1)


def close(a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the difference of two sets may be small enough, told by the cells whose parities differ.

    ``d`` shingles on one side only make an odd number in m (1 - exp(-2d/m)) / 2
    of m cells; differences too large for the cells pass.
    """
    odd = np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)
    most = (count_a + count_b) * (100 - percent) / (100 + percent)
    spread = np.sqrt(np.maximum(PARITIES / 4 * np.expm1(np.minimum(4 * most / PARITIES, 20)) - most, 1))
    limit = most + MARGIN * spread + 1
    return odd <= PARITIES / 2 * -np.expm1(-2 * limit / PARITIES)


def likely(estimate: np.ndarray, used: np.ndarray, percent: int) -> np.ndarray:
    """Whether the similarity may reach the threshold, in all but a few of a million cases."""
    t = percent / 100
    return estimate >= t - MARGIN * np.sqrt(t * (1 - t) / used)


def _registers(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, REGISTERS)


def _parities(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u8").reshape(-1, PARITIES // 64)


def sketches(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """(key, content, n, digest, sketch, parity) of every row; NULL from the digest on without words."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, content, body in zip(batch["key"], batch["content"], batch["text"]):
                found = shingles(body, size)
                if len(found):
                    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    made_of = sketch(found).astype("<u2").tobytes(), parity(found).tobytes()
                    rows.append((doc, content, len(found), digest, *made_of))
                else:
                    rows.append((doc, content, 0, None, None, None))
            yield pd.DataFrame(rows, columns=["key", "content", "n", "digest", "sketch", "parity"])

    source = docs.select(
        F.col(key).cast("string").alias("key"),
        content_id(F.col(text)).alias("content"),
        or_empty(F.col(text)).alias("text"),
    )
    rows = source.mapInPandas(made, "key string, content string, n long, digest binary, sketch binary, parity binary")
    return rows.withColumn("key", F.col("key").cast(docs.schema[key].dataType))


def nodes_of(rows: DataFrame) -> DataFrame:
    """(node, digest, key, n, sketch, parity): one row per distinct set, with its smallest key."""
    linked = rows.filter(F.col("digest").isNotNull() & F.col("key").isNotNull())
    sets = linked.groupBy("digest").agg(
        F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("n", "sketch", "parity")]
    )
    return cut_lineage(sets.withColumn("node", F.monotonically_increasing_id()))


def buckets_of(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node, size) for every band that is not empty, of buckets with two nodes or more."""
    wide = 2 * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(b.alias("band"), F.substr("sketch", b * wide + 1, F.lit(wide)).alias("part")),
    )
    rows = nodes.select("node", F.explode(bands).alias("x")).filter(F.col("x.part") != F.lit(bytes(wide)))
    rows = rows.select(F.xxhash64("x.band", "x.part").alias("bucket"), "x.band", "node")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return cut_lineage(rows.join(sizes, "bucket"))


def stars_of(buckets: DataFrame) -> DataFrame:
    """(a, b): each node with the hub of each of its buckets.

    The hub is the member that stands in the most crowded buckets: in a group
    of near copies the one closest to all others.
    """
    weights = buckets.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = buckets.join(weights, "node").groupBy("bucket").agg(
        F.max_by("node", F.struct("weight", "node")).alias("hub")
    )
    stars = buckets.select("bucket", "node").join(hubs, "bucket").filter("node <> hub")
    return stars.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, estimate) of the pairs that may reach the threshold."""

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            estimate, used = agreement(
                _registers(batch["sa"]), _registers(batch["sb"]), batch["na"].to_numpy(float), batch["nb"].to_numpy(float)
            )
            batch["estimate"] = estimate
            yield batch.loc[likely(estimate, used, percent), ["a", "b", "estimate"]]

    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    # Set sizes alone rule out many pairs.
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").filter(near)
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInPandas(judged, "a long, b long, estimate double")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    """Those pairs (a, b) whose full sets reach the threshold.

    The sets are made again from the texts of the nodes concerned, one document
    per node.
    """
    pairs = cut_lineage(pairs.select("a", "b").distinct())
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = cut_lineage(nodes.join(needed, "node", "left_semi").select("node", F.col("key").alias("__key"), "digest"))
    small = wanted.count() <= BROADCAST_NODES

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for node, digest, body in zip(batch["node"], batch["digest"], batch["text"]):
                found = shingles(body, size)
                # A key may stand for several rows: the one with this set is meant.
                if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == digest:
                    rows.append((node, found.tobytes()))
            yield pd.DataFrame(rows, columns=["node", "shingles"])

    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    chosen = texts.join(F.broadcast(wanted) if small else wanted, F.col("key") == F.col("__key"))
    sets = chosen.select("node", "digest", "text").mapInPandas(made, "node long, shingles binary")
    # Repeated rows of one key give one set.
    sets = cut_lineage(sets.dropDuplicates(["node"]))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for left, right in zip(batch["sa"], batch["sb"]):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return cut_lineage(joined.mapInPandas(judged, "a long, b long"))


def across(buckets: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of one bucket that lie in different components.

    Buckets of a single component are left out.  The others are cut into
    blocks: a component that fills more than one block has blocks of its own,
    and those are compared only with blocks that hold something else.
    """
    members = buckets.join(roots, "node", "left").select(
        "bucket", "band", "node", F.coalesce("root", "node").alias("comp")
    )
    mixed_buckets = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    members = cut_lineage(members.join(mixed_buckets.select("bucket"), "bucket", "left_semi"))
    share = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("held"))
    crowd = share.withColumn("own", F.col("held") > BLOCK)
    rest = crowd.groupBy("bucket").agg(
        F.sum(F.when(~F.col("own"), F.col("held")).otherwise(0)).alias("others"),
        F.sum(F.when(F.col("own"), F.ceil(F.col("held") / BLOCK)).otherwise(0)).alias("owned"),
    )
    placed = members.join(crowd, ["bucket", "comp"]).join(rest, "bucket")
    shared = F.ceil(F.col("others") / BLOCK)
    placed = placed.select(
        "bucket",
        "band",
        "node",
        "comp",
        F.when(F.col("own"), F.col("comp")).otherwise(F.lit(-1).cast("long")).alias("whose"),
        F.pmod(F.xxhash64("node"), F.when(F.col("own"), F.ceil(F.col("held") / BLOCK)).otherwise(shared)).alias("part"),
        (F.col("owned") + shared > 1).alias("several"),
    ).join(nodes.select("node", "n", "sketch", "parity"), "node")
    fields = ("node", "comp", "n", "sketch", "parity")
    # A block has BLOCK members on average.
    blocks = cut_lineage(
        placed.groupBy("bucket", "band", "whose", "part", "several").agg(F.collect_list(F.struct(*fields)).alias("members"))
    )
    # Blocks of small components are compared within; of one large component only with other blocks.
    within = blocks.filter("whose = -1").select("band", F.col("members").alias("l"), F.col("members").alias("r"))
    many = blocks.filter("several")
    left = many.select("bucket", "band", F.col("whose").alias("lw"), F.col("part").alias("lp"), F.col("members").alias("l"))
    right = many.select("bucket", "band", F.col("whose").alias("rw"), F.col("part").alias("rp"), F.col("members").alias("r"))
    between = left.join(right, ["bucket", "band"]).filter(
        (F.struct("lw", "lp") < F.struct("rw", "rp")) & ((F.col("lw") != F.col("rw")) | (F.col("lw") == -1))
    )
    pairs = within.unionByName(between.select("band", "l", "r")).select(
        "band", *[F.col(f"{side}.{field}").alias(f"{side}_{field}") for side in "lr" for field in fields]
    )

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = set()
            for row in batch.itertuples(index=False):
                ln, rn = np.asarray(row.l_node), np.asarray(row.r_node)
                lc, rc = np.asarray(row.l_comp), np.asarray(row.r_comp)
                lk, rk = np.asarray(row.l_n, float), np.asarray(row.r_n, float)
                ls, rs = _registers(row.l_sketch), _registers(row.r_sketch)
                lp, rp = _parities(row.l_parity), _parities(row.r_parity)
                for i in range(len(ln)):
                    fits = (rc != lc[i]) & (np.minimum(rk, lk[i]) * 100 >= np.maximum(rk, lk[i]) * percent)
                    js = np.flatnonzero(fits)
                    if len(js):
                        estimate, used = agreement(ls[i][None], rs[js], lk[i], rk[js])
                        js = js[likely(estimate, used, percent)]
                    if len(js):
                        js = js[close(lp[i][None], rp[js], lk[i], rk[js], percent)]
                    if len(js):
                        # A pair is told by the first band that it shares.
                        js = js[first_band(ls[i][None], rs[js]) == row.band]
                        out.update((min(ln[i], rn[j]), max(ln[i], rn[j])) for j in js)
            yield pd.DataFrame(sorted(out), columns=["a", "b"], dtype="int64")

    return pairs.mapInPandas(found, "a long, b long")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 85, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: the key, ``content``, ``n_shingles``, ``component_id`` and ``kept``.

    Two documents are linked if the share of common shingles reaches
    ``percent``; a component is what links connect, named by its smallest key;
    the document with that key is kept.

    Documents without words, and rows without a key, are linked with nothing
    and kept (``component_id`` is the key).  Repeated rows give one row each;
    rows that share a key but not a text are judged each by its own text.
    Other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = cut_lineage(sketches(docs, size, key, text))
    nodes = nodes_of(rows)
    buckets = buckets_of(nodes)
    # First the likeliest partner of each node among the hubs of its buckets ...
    best = estimated(stars_of(buckets), nodes, percent).groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a"))
    links = confirmed(best, nodes, docs, size, percent, key, text)
    roots = connected(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # ... then everything that still lies apart.
    pairs = across(buckets.select("bucket", "band", "node"), nodes, roots, percent)
    more = confirmed(pairs, nodes, docs, size, percent, key, text)
    # What was connected before is one node now.
    first, second = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    joints = more.join(first, "a", "left").join(second, "b", "left")
    joints = connected(joints.select(F.coalesce("root_a", "a").alias("u"), F.coalesce("root_b", "b").alias("v")))

    members = nodes.select("node", "digest", F.col("key").alias("first")).join(roots, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node")).join(
        joints.select(F.col("node").alias("root"), F.col("root").alias("joint")), "root", "left"
    )
    members = members.withColumn("root", F.coalesce("joint", "root"))
    names = members.groupBy("root").agg(F.min("first").alias("component"))
    named = members.join(names, "root").select("digest", "component")
    found = rows.select("key", "content", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return found.select(
        F.col("key").alias(key),
        "content",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )


def drop_copies(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that are not kept; all their columns stay."""
    gone = found.filter(~F.col("kept")).select(F.col(key).alias("__key"), F.col("content").alias("__content"))
    same = docs[key].eqNullSafe(gone["__key"]) & (content_id(docs[text]) == gone["__content"])
    return docs.join(gone.distinct(), same, "left_anti")
