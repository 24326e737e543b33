"""Jaccard join of word-shingle sets by parity sketches.

A set of n shingle hashes is cut by hash into P blocks, and each block keeps the XOR of its
hashes, a parity word that one more or one less element always changes.  So the number of
differing blocks (the Hamming distance of two sketches) is at most the symmetric difference of
the sets, which the similarity bounds by D for the sizes of a band.  With P = D + 1 + slack
blocks two linked sets agree in more than ``slack`` blocks (pigeonhole), which an equi-join on
(band, block, parity word) finds; candidates are verified on the whole sets.

The slack lets a set leave out up to that many blocks without losing a link: one part of it goes to
blocks of at most one shingle, the other to blocks that very many sets share.  Sets with more
shared blocks than that meet once more by their rarest shingles.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import fresh, materialise, small_or_shuffled, temporary
from millrace.llm.links import components

_GAP = re.compile(rb"[\x20\x09-\x0d]")
SHINGLE = 4
SIMILARITY = 85
# Each band of set sizes reaches to this multiple of its smallest size.
BAND = 1.25
# Sets of up to SMALL shingles use SEEDS independent cuts, as their blocks may all be empty.
SMALL, SEEDS = 40, 3
# Buckets with more open sets than this are not joined pair by pair.
LARGE = 16
# Sets that a task compares with as many others.
TILE = 500
# A Bloom filter of the sets to verify is shipped up to this many bytes.
BLOOM_BYTES = 32 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


# A word is hashed as a polynomial of one random number for each byte value, whose base is _ODD.
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
# Bytes that are hashed in one go; a cut never falls into a word.
GO_BYTES = 1 << 19


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    up, down = np.full(size, _ODD), np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the byte where it starts."""
    hashes, places, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(text):
        end = at + GO_BYTES
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        data = np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)
        size = max(GO_BYTES, 1 << (len(data) - 1).bit_length())
        up, down = _powers(size)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_SPACE[data]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        upto = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=upto[1:])
        hashes.append((upto[ends] - upto[starts]) * down[starts])
        places.append(starts + at)
        at += len(data)
    return np.concatenate(hashes), np.concatenate(places)


def shingles(texts: Sequence[bytes | None], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles; fewer words than ``width`` are one shingle."""
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first] or b"")
        while last < len(texts) and size + len(texts[last] or b"") <= GO_BYTES:
            size += len(texts[last] or b"")
            last += 1
        yield from _shingles([t or b"" for t in texts[first:last]], width)
        first = last


def _shingles(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    hashes, places = word_hashes(b" ".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.concatenate([[0], np.searchsorted(places, ends)])
    one = _mixed(hashes)
    factors = _mixed(np.arange(1, width + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    whole = np.full(max(0, len(one) - width + 1), width, np.uint64)
    for k in range(width):
        whole += one[k : k + len(whole)] * factors[k]
    whole = _mixed(whole)
    for begin, end in zip(upto[:-1].tolist(), upto[1:].tolist()):
        if begin < end < begin + width:
            yield _mixed((one[begin:end] * factors[: end - begin]).sum(keepdims=True) + np.uint64(end - begin))
        else:
            yield np.unique(whole[begin : max(begin, end - width + 1)])


@lru_cache
def bands(similarity: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Largest size of every band, and the largest symmetric difference of a pair whose smaller set is in it."""
    smallest = -(-similarity // (100 - similarity))
    tops, top = [], smallest - 1
    while top < 1 << 32:
        top = max(top + 1, int((top + 1) * BAND))
        tops.append(top)
    return tuple(tops), tuple(t * (100 - similarity) // similarity for t in tops)


@lru_cache
def _few_share(similarity: int) -> float:
    """Part of D + 1 by which blocks of few shingles may be left out, about twice the expected empty ones."""
    share = 0.1
    while math.exp(-similarity / (100 - similarity) / BAND / (1.1 + share)) > 0.56 * share / (1.1 + share):
        share += 0.05
    return share


def slack(difference: int, similarity: int) -> tuple[int, int]:
    """Blocks beyond D + 1 that a set may leave out: those with few shingles, those that are shared by many."""
    return math.ceil(_few_share(similarity) * (difference + 1)), math.ceil((difference + 1) / 10)


def keys_of(found: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    """Join keys of a set for its own band and for the bands of smaller partners; the low byte is the band."""
    tops, differences = bands(similarity)
    n = len(found)
    own = bisect_left(tops, n)
    # Sets too small for a difference of one are linked with equal ones only.
    if n * (100 - similarity) // similarity < 1:
        return np.zeros(0, np.int64)
    out = []
    for band in range(own, -1, -1):
        if band < own and tops[band] * 100 < similarity * n:
            break
        few, many = slack(differences[band], similarity)
        blocks = differences[band] + 1 + few + many
        seeds = SEEDS if tops[band] <= SMALL else 1
        passed = False
        for seed in range(seeds):
            placed = found if not seed else np.sort(_mixed(found + np.uint64(seed)))
            block = ((placed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
            starts = np.searchsorted(block, np.arange(blocks + 1, dtype=np.uint64))
            counts = np.diff(starts)
            filled = counts > 0
            parity = np.zeros(blocks, np.uint64)
            parity[filled] = np.bitwise_xor.reduceat(placed, starts[:-1][filled])
            if (counts <= 1).sum() <= few:
                passed, kept = True, counts > 1
            elif (~filled).sum() <= few:
                passed, kept = True, filled
            else:
                kept = np.ones(blocks, bool) if seed == seeds - 1 and not passed else filled
            place = np.arange(blocks, dtype=np.uint64)[kept] + np.uint64(band << 32 | seed << 56)
            keys = _mixed(parity[kept] * _ODD + _mixed(place))
            out.append(keys & np.uint64(0xFFFFFFFFFFFFFF00) | np.uint64(band))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def _node(found: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64)))


def _describe(width: int, similarity: int):
    """(doc_id, text_key, text) rows to (doc_id, text_key, n, node, keys); of equal sets in a task only the first has its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int | None] = {None}
        for whole in batches:
            for part in range(0, whole.num_rows, 500):
                batch = whole.slice(part, 500)
                sizes, nodes, keys, counts = [], [], [np.zeros(0, np.int64)], []
                for found in shingles([text.as_py() for text in batch.column(2)], width):
                    node = _node(found) if len(found) else None
                    sizes.append(len(found))
                    nodes.append(node)
                    keys.append(np.zeros(0, np.int64) if node in seen else keys_of(found, similarity))
                    counts.append(len(keys[-1]))
                    seen.add(node)
                ends = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), lists],
                    names=["doc_id", "text_key", "n", "node", "keys"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, node) in order: those whose key another node has too, with the key's first node."""
    last_key = last_node = leader = None
    told = False
    for batch in batches:
        keys, nodes = (batch.column(i).to_numpy() for i in range(2))
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        if len(keys) and keys[0] == last_key and nodes[0] == last_node:
            fresh[0] = False
        keys, nodes = keys[fresh], nodes[fresh]
        if not len(keys):
            continue
        begins = np.ones(len(keys), bool)
        begins[1:] = keys[1:] != keys[:-1]
        goes_on = keys[0] == last_key
        begins[0] = not goes_on
        starts = np.flatnonzero(begins)
        run = np.cumsum(begins) - 1
        leaders = nodes[starts[run]] if len(starts) else np.zeros(len(keys), np.int64)
        size = np.bincount(run[run >= 0], minlength=len(starts)) if len(starts) else np.zeros(0, int)
        shared = np.zeros(len(keys), bool)
        shared[run >= 0] = size[run[run >= 0]] > 1
        head = run < 0
        out_keys, out_nodes = [keys[shared]], [nodes[shared]]
        out_leaders = [leaders[shared]]
        if head.any():
            if not told:
                out_keys.append(np.array([last_key]))
                out_nodes.append(np.array([leader]))
                out_leaders.append(np.array([leader]))
                told = True
            out_keys.append(keys[head])
            out_nodes.append(nodes[head])
            out_leaders.append(np.full(head.sum(), leader))
        if len(starts):
            leader, told = nodes[starts[-1]], bool(size[-1] > 1)
        last_key, last_node = keys[-1], nodes[-1]
        yield pa.RecordBatch.from_pydict(
            {"key": np.concatenate(out_keys), "node": np.concatenate(out_nodes), "leader": np.concatenate(out_leaders)}
        )


def _bloom_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    first = _mixed(keys.view(np.uint64))
    second = _mixed(first) | np.uint64(1)
    return [(first + second * np.uint64(k)) % np.uint64(bits) for k in range(4)]


class Verifier:
    """Checks candidate pairs of nodes against the whole sets.

    Only texts that may belong to a candidate are read into sets again: their keys go into a
    Bloom filter of 16 bits each, shipped while it is below BLOOM_BYTES; beyond that the texts
    meet the candidates in a shuffle join.
    """

    def __init__(self, docs: DataFrame, rows: DataFrame, width: int, similarity: int):
        self.docs, self.width, self.similarity = docs, width, similarity
        self.nodes = materialise(
            rows.filter("n > 0").groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("n").alias("n")), "sets"
        )

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough."""
        sizes = self.nodes.select("node", "n", "text_key")
        a, b = (sizes.withColumnsRenamed({"node": s, "n": f"n_{s}", "text_key": f"text_{s}"}) for s in "ab")
        near = pairs.join(a, "a").join(b, "b").filter(
            F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.similarity
        )
        with temporary(self.docs.sparkSession):
            near = materialise(near, "candidates")
            wanted = materialise(
                near.select(F.col("text_a").alias("text_key")).union(near.select("text_b")).distinct(), "wanted"
            )
            sets = materialise(self._sets(wanted), "candidate-sets").dropDuplicates(["node"])
            met = near.select("a", "b", "n_a", "n_b").join(sets.withColumnsRenamed({"node": "a", "found": "found_a"}), "a")
            met = met.join(sets.withColumnsRenamed({"node": "b", "found": "found_b"}), "b")
            both = F.size(F.array_intersect("found_a", "found_b"))
            checked = met.select("a", "b", (both * 100 >= (F.col("n_a") + F.col("n_b") - both) * self.similarity).alias("_near"))
            return materialise(checked.filter("_near").select("a", "b"), "similar", outlives=True)

    def rarest(self, nodes: DataFrame) -> DataFrame:
        """(key, node) of the shingles by which linked sets among ``nodes`` must meet.

        Ordered from rare to frequent, two similar sets share one of their first
        n - ceil(n * similarity / 100) + 1 shingles, whatever common passages they hold.
        """
        each = materialise(self.sets(nodes).select("node", F.size("found").alias("n"), F.explode("found").alias("key")), "tainted-sets")
        counts = each.groupBy("key").agg(F.count(F.lit(1)).alias("sets"))
        place = F.row_number().over(Window.partitionBy("node").orderBy("sets", "key"))
        first = F.col("n") - F.ceil(F.col("n") * self.similarity / 100) + 1
        return each.join(counts, "key").withColumn("_place", place).filter(F.col("_place") <= first).select("key", "node")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, found) of some nodes, in a written table."""
        wanted = materialise(nodes.join(self.nodes, "node").select("text_key").distinct(), "wanted")
        return materialise(self._sets(wanted).dropDuplicates(["node"]).join(nodes, "node", "left_semi"), "candidate-sets")

    def _sets(self, wanted: DataFrame) -> DataFrame:
        width = self.width
        count = wanted.count()
        texts = self.docs.select(F.xxhash64(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nodes, sets = [], []
                for found in shingles([text.as_py() for text in batch.column(1)], width):
                    if len(found):
                        nodes.append(_node(found))
                        sets.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "found"])

        bits = max(1 << 16, 16 * count)
        if bits // 8 > BLOOM_BYTES:
            return texts.join(wanted, "text_key", "left_semi").mapInArrow(run, "node long, found array<long>")

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for places in _bloom_places(batch.column(0).to_numpy(), bits):
                    yield pa.RecordBatch.from_pydict({"word": (places // np.uint64(64)).astype(np.int64), "bit": np.int64(1) << (places % np.uint64(64)).astype(np.int64)})

        words = wanted.mapInArrow(fill, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
        bloom = np.zeros(bits // 64 + 1, np.int64)
        bloom[words["word"].to_numpy()] = words["bits"].to_numpy()
        shared = self.docs.sparkSession.sparkContext.broadcast(bloom)

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filled = shared.value
            for batch in batches:
                maybe = np.ones(batch.num_rows, bool)
                for places in _bloom_places(batch.column(0).to_numpy(), bits):
                    maybe &= (filled[(places // np.uint64(64)).astype(np.int64)] >> (places % np.uint64(64)).astype(np.int64)) & 1 == 1
                yield batch.filter(pa.array(maybe))

        return texts.mapInArrow(lambda batches: run(sift(batches)), "node long, found array<long>")


def sketched(docs: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Two written tables: documents (doc_id, text_key, set size n, node: digest of the set, null if
    empty), and the join keys that several sets have (key, node, leader: the key's first node)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    whole = materialise(rows.mapInArrow(_describe(width, similarity), "doc_id long, text_key long, n long, node long, keys array<long>"), "documents")
    described = whole.drop("keys")
    entries = whole.filter(F.size("keys") > 0).select(F.explode("keys").alias("key"), "node")
    dealt = entries.repartition("key").sortWithinPartitions("key", "node")
    return described, materialise(dealt.mapInArrow(_shared, "key long, node long, leader long"), "shared-keys")


def linked_sets(
    docs: DataFrame, rows: DataFrame, shared: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """(node, comp) of every set that is linked to a different one, from the tables of ``sketched``.

    First every set meets the leader with which it shares most keys.  Then only buckets that still
    hold sets of different components matter: up to LARGE sets meet each other, larger buckets are
    left out where the slack allows it, and the sets for which it does not meet by rare shingles.
    """
    verifier = Verifier(docs, rows, width, similarity)
    # A leader that shares a few keys only is no likely partner; the second step misses nothing.
    votes = shared.filter("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("votes"), F.min(_band("key")).alias("band"))
    votes = votes.filter(F.col("votes") > _allowed("band", similarity) / 2)
    best = votes.groupBy("node").agg(F.max_by("leader", F.struct("votes", "leader")).alias("leader"))
    links = verifier.links(best.select(F.col("leader").alias("a"), F.col("node").alias("b")))
    comps = components(links)

    def meet(opened: DataFrame, enough=None) -> None:
        """Link sets of different components in the buckets of up to LARGE sets; ``enough`` sifts the pairs."""
        nonlocal links, comps
        x, y = (opened.filter(F.col("members") <= LARGE).select("key", F.col("node").alias(s), F.col("comp").alias(f"comp_{s}")) for s in "ab")
        pairs = x.join(y, "key").filter("a < b and comp_a <> comp_b")
        more = verifier.links((enough(pairs) if enough else pairs).select("a", "b").distinct())
        if more.limit(1).count():
            links = links.unionByName(more)
            comps = components(links)

    opened = materialise(_opened(shared.select("key", "node"), comps), "open-keys")
    weights = materialise(_large_keys(opened, similarity), "large-keys")
    meet(opened, lambda pairs: _agreeing(pairs, weights, similarity))
    tainted = materialise(weights.filter("weight > allowed").select("node").distinct(), "tainted")
    if tainted.limit(1).count():
        opened = materialise(_opened(verifier.rarest(tainted), comps), "open-rare")
        meet(opened)
        dense = materialise(opened.filter(F.col("members") > LARGE).select("key", "node"), "dense")
        if dense.limit(1).count():
            links = links.unionByName(_dense_links(dense, verifier, similarity))
            comps = components(links)
    return comps


def _opened(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of the keys whose nodes lie in different components, with comp and the key's number of rows."""
    placed = shared.drop("comp", "members").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    keys = placed.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count(F.lit(1)).alias("members"))
    return placed.join(keys.filter("_lo <> _hi").select("key", "members"), "key")


def _dense_links(dense: DataFrame, verifier: Verifier, similarity: int) -> DataFrame:
    """Links that connect what is linked among sets that share even their rarest shingles with many.

    Such sets are variants of one text, nearly all of which would be candidates.  A family (sets
    connected by such shingles) is dealt into blocks of TILE sets; a task compares two blocks by
    counting common shingles in a matrix product and returns a spanning forest, never all pairs.
    """
    heads = dense.groupBy("key").agg(F.min("node").alias("head"))
    family = components(dense.join(heads, "key").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    sizes = family.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    placed = family.join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = placed.select("node", "comp", "block", other.alias("other")).select(
        "node", "comp", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    )

    def compare(key: tuple, part: pa.Table) -> pa.Table:
        nodes = part.column("node").to_numpy()
        sets = [np.asarray(v.as_py(), np.int64) for v in part.column("found")]
        return pa.table(dict(zip("ab", _forest(nodes, sets, similarity))))

    met = tiles.join(verifier.sets(family.select("node")), "node")
    return materialise(met.groupBy("comp", "x", "y").applyInArrow(compare, "a long, b long"), "dense-links")


def _forest(nodes: np.ndarray, sets: list[np.ndarray], similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between ``sets``."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    words, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(often > 1) - 1
    owner, column = owner[often[place] > 1], rank[place[often[place] > 1]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int((often > 1).sum()), 4096):
        here = (column >= first) & (column < first + 4096)
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[here], column[here] - first] = 1
        both += part @ part.T
    common = np.rint(both).astype(np.int64)
    linked = common * 100 >= (sizes[:, None] + sizes[None, :] - common) * similarity
    left, a, b = np.ones(len(sets), bool), [], []
    while left.any():
        front = [int(np.argmax(left))]
        left[front[0]] = False
        while front:
            at = front.pop()
            found = np.flatnonzero(linked[at] & left)
            left[found] = False
            front += found.tolist()
            a += [nodes[at]] * len(found)
            b += nodes[found].tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _band(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit(255)).cast("int")


def _allowed(band: str, similarity: int) -> Column:
    """Blocks shared by many that the slack lets a set leave out in a band."""
    _, differences = bands(similarity)
    return F.element_at(F.array(*[F.lit(slack(d, similarity)[1]) for d in differences]), F.col(band) + 1)


def _large_keys(opened: DataFrame, similarity: int) -> DataFrame:
    """(node, band, weight, allowed): how many large buckets a node has in a band.

    A node with no more of them than allowed loses no link without them.
    """
    large = opened.filter(F.col("members") > LARGE).withColumn("band", _band("key"))
    return large.groupBy("node", "band").agg(F.count(F.lit(1)).alias("weight")).withColumn("allowed", _allowed("band", similarity))


def _agreeing(pairs: DataFrame, weights: DataFrame, similarity: int) -> DataFrame:
    """Pairs that agree in as many blocks as linked sets must.

    Linked sets agree in more blocks than both parts of the slack together.  At most one part is
    left out for its few shingles, and large buckets are not counted here, so what remains is more
    than the other part less the large buckets of either set.
    """
    counted = pairs.withColumn("band", _band("key")).groupBy("a", "b", "band").agg(F.count(F.lit(1)).alias("agree"))
    known = weights.select("node", "band", "weight")
    for side in "ab":
        counted = counted.join(known.withColumnsRenamed({"node": side, "weight": f"w_{side}"}), [side, "band"], "left")
    left_out = F.least(F.coalesce("w_a", F.lit(0)), F.coalesce("w_b", F.lit(0)))
    return counted.filter(F.col("agree") > _allowed("band", similarity) - left_out)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of every document.

    Documents link when 100 * intersection >= similarity * union of their sets of ``width``-word
    shingles (A-Z lower-cased; fewer words are one shingle).  component_id is the smallest doc_id
    reachable by links; null ids are reached but are not a smallest id.  Null texts and texts
    without words have an empty set and link with nothing.  Repeated rows and equal texts share a
    set and are linked through it, never in pairs.  Only doc_id and text are read.
    """
    with temporary(docs.sparkSession):
        rows, shared = sketched(docs, width, similarity)
        comps = linked_sets(docs, rows, shared, width, similarity)
        small = rows.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "node")
        whole = small.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        placed = materialise(whole, "placed", outlives=True)
    firsts = placed.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("_first"))
    return placed.join(firsts, "comp", "left").select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("_first")).alias("component_id"), "comp"
    )


def one_of_each(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """One document of each group of near duplicates (that with the smallest id), with all columns.

    Rows without words are kept as they are; of rows that repeat id and text one stays.
    """
    marked = materialise(near_duplicates(docs, width, similarity).select("doc_id", "text_key", "comp"), "marked").filter("comp is not null")
    order = F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i"), F.col("text_key").alias("t"))
    stays = marked.groupBy("comp").agg(F.min(order).alias("o")).select(F.col("o.i").alias("_id"), F.col("o.t").alias("_text"))
    goes = marked.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text")), "left_anti").distinct()
    goes = materialise(goes, "copies")
    own_id, own_text = fresh("gone_id", docs.columns), fresh("gone_text", docs.columns)
    gone = goes.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_text))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_text))
    left = docs.join(small_or_shuffled(gone), same, "left_anti")
    if marked.groupBy("doc_id", "text_key").count().filter("count > 1").limit(1).count():
        wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        left = left.filter(~wordless).dropDuplicates(["doc_id", "text"]).unionByName(left.filter(wordless))
    return left
