"""Components of similar sets, shared by the near-duplicate operators.

Items are sets of 64-bit hashes with a minwise sketch. Candidate generators put
items into nodes (groups that may hold similar items); here nodes are worked
off without emitting all pairs of a group:

1. Star: every item of a node is held against the node's leader (the member of
   least hashed id, so nodes with the same members agree on it) by their codes, four bits
   of each minwise value. Of the leaders that its code allows, an item is verified
   against the one that agrees best, on the full sets; links are merged into components.
2. A node whose items all lie in one component is done. In a small node each
   item is first verified against the item of another component that its code agrees
   with best; these links merge components. The pairs of items that still are of
   different components are then compared, together with the next levels' first pairs. A large node is
   branched further, and the same steps follow: its items go to the children named by
   one place of the sketch and its value there, and with a chance of a half to
   those of a second place. So a node never ends without children, items of a similarity
   below 2 / 3 thin out, and at 0.75 a pair keeps 1.125 common children on average.

A code rules a pair out only if its agreement lies ``SIGMAS`` standard deviations
below that of the least similarity, which a linked pair reaches with a chance of
about 3e-6. A code followed by a parity sketch also rules out pairs whose sizes or
parities differ more than those of a linked pair ever do. Two items already in one
component need no further link, so the components are those of all links found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import chunks, materialise
from barframe.session import discard

#: Minwise values of a sketch, 32 bits each.
SKETCH = 128
SIGMAS = 4.5
#: Bits of a parity sketch.
PARITY = 1024
#: Chance that a node below the root branches on a second place.
SECOND = 1 / 2
#: Largest node whose pairs are compared one by one.
SMALL_NODE = 256
#: Edges that shrink to stars at a time.
EDGES = 1 << 20
#: Bytes of text handled at a time.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: What tells the minwise hash functions apart, from a rule.
SEEDS = (mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)).astype(np.uint32)

_RADIX = np.uint64(0x5851F42D4C957F2D)
_RADIX_INV = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word of UTF-8 bytes, by prefix polynomial hashes modulo 2**64."""
    gap = _GAP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(_RADIX, len(raw)), dtype=np.uint64)))
        h = (prefix[end] - prefix[start]) * powers(_RADIX_INV, len(raw) + 1)[start]
    return mix(h + (end - start).astype(np.uint64)), start, end


def shingle_sets(raws: list[bytes | None], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; a shorter text is one shingle of all its words."""
    kept = [r.translate(LOWER) if r else b"" for r in raws]
    joined = np.frombuffer(b" ".join(kept), np.uint8)
    if not len(joined):
        return [np.zeros(0, np.uint64) for _ in raws]
    h, start, _ = word_hashes(joined)
    at = np.searchsorted(start, np.cumsum([0] + [len(r) + 1 for r in kept]))
    out = []
    with np.errstate(over="ignore"):
        scale = powers(np.uint64(0xA0761D6478BD642F), k)
        full = sum(h[j:len(h) - (k - 1) + j] * scale[j] for j in range(k)) if len(h) >= k else np.zeros(0, np.uint64)
        full = mix(full)
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= k:
                out.append(np.unique(full[a:b - k + 1]))
            elif b > a:
                out.append(mix(np.array([(h[a:b] * scale[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def halves(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two 32-bit halves of hashes, which the minwise functions take in turn."""
    return s.astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)


def scrambled(x: np.ndarray) -> np.ndarray:
    """32-bit values scrambled in place (a bijection)."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def minwise(parts: tuple[np.ndarray, np.ndarray], j: int) -> np.ndarray:
    """The j-th hash function of hashes in halves: each scrambles its own seeded copy, so the functions don't depend on one another."""
    return scrambled(parts[j & 1] ^ SEEDS[j])


#: Hashes that go through all functions at a time.
AT_ONCE = 2048


def sketch(s: np.ndarray) -> np.ndarray:
    """Minwise values of a non-empty set."""
    out = np.full(SKETCH, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(s), AT_ONCE):
        for k, part in enumerate(halves(s[a:a + AT_ONCE])):
            least = scrambled(part[None, :] ^ SEEDS[k::2, None]).min(1)
            np.minimum(out[k::2], least, out=out[k::2])
    return out


def code(sketches: np.ndarray) -> np.ndarray:
    """Four bits of each minwise value, (n, SKETCH) -> (n, SKETCH / 2) bytes."""
    low = (sketches & np.uint32(15)).astype(np.uint8)
    return low[:, ::2] | low[:, 1::2] << 4


#: Number of equal halves of two bytes, by their xor.
EQUAL = np.array([(b & 15 == 0) + (b >> 4 == 0) for b in range(256)], np.uint8)


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of places at which codes agree, row by row."""
    return EQUAL[x ^ y].sum(1, dtype=np.int64) / SKETCH


def parity(s: np.ndarray) -> bytes:
    """Size of a set, and for each of ``PARITY`` places whether an odd number of its hashes fall there.

    Each hash that only one of two sets holds changes one place, so the sketches of two
    sets differ at no more places than their symmetric difference has hashes."""
    odd = np.bincount((mix(s ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.uint32(len(s)).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def allowed(x: np.ndarray, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(agreement, mask of the pairs not ruled out) of codes, row by row; a code may be followed by its ``parity``."""
    agree = alike(x[:, :SKETCH // 2], y[:, :SKETCH // 2])
    keep = agree >= least_agreement(percent / 100)
    if x.shape[1] > SKETCH // 2:
        at = np.flatnonzero(keep)
        x, y = (np.ascontiguousarray(z[at, SKETCH // 2:]) for z in (x, y))
        n, m = (z[:, :4].copy().view(np.uint32)[:, 0].astype(np.int64) for z in (x, y))
        apart = np.bitwise_count(x[:, 4:] ^ y[:, 4:]).sum(1, dtype=np.int64)
        # 100 * common >= percent * union bounds the difference by (100 - percent) / (100 + percent) of both sizes
        keep[at] = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * apart <= (100 - percent) * (n + m))
    return agree, keep


def _codes(column) -> np.ndarray:
    """(n, width) bytes of a column of codes of one width."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1) if rows else np.zeros((0, SKETCH // 2), np.uint8)


def paths(sketches: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """(n, trees) nodes: each tree starts with a path of ``depth`` places of its own."""
    order = np.argsort(mix(np.arange(SKETCH, dtype=np.uint64) + np.uint64(99)))
    places = order[:trees * depth].reshape(trees, depth)
    node = np.tile(mix(np.arange(1, trees + 1, dtype=np.uint64)), (len(sketches), 1))
    for i in range(depth):
        node = mix(node ^ mix(sketches[:, places[:, i]].astype(np.uint64) + np.uint64(i + 1 << 32)))
    return node


def fingerprint(s: np.ndarray) -> bytes:
    """128 bits and the size of a set; equal sets have equal ones."""
    with np.errstate(over="ignore"):
        return np.array([s.sum(dtype=np.uint64), mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64), len(s)], np.uint64).tobytes()


def chosen(node: np.ndarray, level: int) -> np.ndarray:
    """Mask (nodes x places) of the places that a node branches on, one or two; the same for all items of the node."""
    with np.errstate(over="ignore"):
        draw = mix(node ^ mix(np.full(1, level + 1, np.uint64)))
    again = mix(draw ^ np.uint64(0x2545F4914F6CDD1D))
    out = np.zeros((len(node), SKETCH), bool)
    first = (draw % np.uint64(SKETCH)).astype(np.int64)
    out[np.arange(len(node)), first] = True
    two = np.flatnonzero(again < np.uint64(int(SECOND * 2 ** 64)))
    step = 1 + ((again[two] >> np.uint64(8)) % np.uint64(SKETCH - 1)).astype(np.int64)
    out[two, (first[two] + step) % SKETCH] = True
    return out


def branch(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """(node, item, sketch) -> (node, item) of the children."""
    for batch in batches:
        node = batch.column("node").to_numpy().view(np.uint64)
        s = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH)
        row, place = np.nonzero(chosen(node, level))
        with np.errstate(over="ignore"):
            child = mix(mix(node[row] + np.uint64(place.astype(np.uint64) + 1) * np.uint64(0xA0761D6478BD642F)) ^ s[row, place].astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column("item").take(pa.array(row))], names=["node", "item"])


def branched(rows: DataFrame, level: int) -> DataFrame:
    """(node, item) of the children of (node, item, sketch) rows."""
    return rows.select("node", "item", "sketch").mapInArrow(lambda x: branch(x, level), "node bigint, item bigint")


def least_agreement(similarity: float) -> float:
    """Share of agreeing places of two codes below which a pair is ruled out."""
    p = similarity + (1 - similarity) / 16
    return p - SIGMAS * (p * (1 - p) / SKETCH) ** 0.5


def agreement(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(item, leader, x, y) -> (item, leader, agree) of the pairs that their codes don't rule out."""
    for batch in batches:
        agree, keep = allowed(_codes(batch.column("x")), _codes(batch.column("y")), percent)
        keep = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("item").filter(keep), batch.column("leader").filter(keep), pa.array(agree).filter(keep)], names=["item", "leader", "agree"])


def star_pairs(nodes: DataFrame, codes: DataFrame, percent: int, seen: DataFrame | None = None) -> DataFrame:
    """(a, b): of each item b the leader a of another component that agrees best, if its code allows a link.

    nodes: (node, item, comp, leader, leader_comp); seen: pairs (a, b) that need no second look."""
    pairs = nodes.where(F.col("comp") != F.col("leader_comp")).select("item", "leader").distinct()
    if seen is not None:
        pairs = pairs.join(seen.select(F.col("a").alias("leader"), F.col("b").alias("item")), ["item", "leader"], "left_anti")
    both = (pairs.join(codes.select("item", F.col("code").alias("x")), "item")
            .join(codes.select(F.col("item").alias("leader"), F.col("code").alias("y")), "leader"))
    agreeing = both.select("item", "leader", "x", "y").mapInArrow(lambda x: agreement(x, percent), "item bigint, leader bigint, agree double")
    best = agreeing.groupBy("item").agg(F.min(F.struct((-F.col("agree")).alias("apart"), "leader")).alias("best"))
    return best.select(F.col("best.leader").alias("a"), F.col("item").alias("b"))


def node_pairs(node: np.ndarray, comp: np.ndarray, s: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, agreement) of the rows of one node and different components whose codes allow a link; no row is twice in one i or j.

    The rows lie in order of their nodes; each is compared with those 1, 2, ... places on."""
    for d in range(1, len(node)):
        same = node[:-d] == node[d:]
        if not same.any():
            return
        i = np.flatnonzero(same & (comp[:-d] != comp[d:]))
        agree, keep = allowed(s[i], s[i + d], percent)
        i, agree = i[keep], agree[keep]
        yield i, i + d, agree


def _every_pair(node, item, comp, s, percent: int) -> pa.RecordBatch:
    out = [np.stack((item[i], item[j])) for i, j, _ in node_pairs(node, comp, s, percent)]
    x, y = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _closest(node, item, comp, s, percent: int) -> pa.RecordBatch:
    best, partner = np.full(len(node), -1.0), np.zeros(len(node), np.int64)
    for i, j, agree in node_pairs(node, comp, s, percent):
        for x, y in ((i, j), (j, i)):
            more = agree > best[x]
            best[x[more]], partner[x[more]] = agree[more], item[y[more]]
    has = np.flatnonzero(best >= 0)
    return pa.RecordBatch.from_arrays([pa.array(item[has]), pa.array(partner[has]), pa.array(best[has])], names=["item", "partner", "agree"])


def _small_nodes(nodes: DataFrame, codes: DataFrame, compare, schema: str) -> DataFrame:
    """``compare(node, item, comp, code)`` of the rows of whole nodes, which lie side by side in sorted partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [*(batch.column(c).to_numpy() for c in ("node", "item", "comp")),
                   _codes(batch.column("code"))]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            cut = np.searchsorted(held[0], held[0][-1])  # the last node may go on
            if cut:
                yield compare(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held is not None:
            yield compare(*held)

    rows = nodes.select("node", "item", "comp").join(codes.select("item", "code"), "item")
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, schema)


def small_node_pairs(nodes: DataFrame, codes: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of different components within small nodes, if their codes allow a link.

    nodes: (node, item, comp), of about ``SMALL_NODE`` items each."""
    return _small_nodes(nodes, codes, lambda *x: _every_pair(*x, percent), "a bigint, b bigint").distinct()


def closest_pairs(nodes: DataFrame, codes: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b): of each item the one of another component that agrees best within its small nodes, if their codes allow a link.

    No more pairs than items, however many items lie in a node."""
    found = _small_nodes(nodes, codes, lambda *x: _closest(*x, percent), "item bigint, partner bigint, agree double")
    best = found.groupBy("item").agg(F.min(F.struct((-F.col("agree")).alias("apart"), "partner")).alias("best")).select("item", F.col("best.partner").alias("partner"))
    return best.select(F.least("item", "partner").alias("a"), F.greatest("item", "partner").alias("b")).distinct()


def _similar(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of (a, part), the text of a (b is null) before those of its partners -> the linked (a, b)."""
    key, head = None, None
    for whole in batches:
        for batch in chunks(iter([whole]), "text", CHUNK):
            left, right = [], []
            sets = shingle_sets([t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()])
            for a, part, b, x in zip(batch.column("a").to_pylist(), batch.column("part").to_pylist(), batch.column("b").to_pylist(), sets):
                if b is None:
                    key, head = (a, part), x
                    continue
                if (a, part) != key or not len(x) or 100 * min(len(x), len(head)) < percent * max(len(x), len(head)):
                    continue
                common = int((x[np.minimum(np.searchsorted(x, head), len(x) - 1)] == head).sum())
                if 100 * common >= percent * (len(x) + len(head) - common):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


#: Partners that a text meets in one place.
PARTNERS = 1000


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * |common| >= percent * |union|.

    pairs: (a, b), written; texts: (item, text). Texts travel, not sets: they are smaller and
    compress. The places that a text is needed in are gathered first, so the texts are joined once.
    The text of a travels once for up to ``PARTNERS`` of its partners, so an item with many is
    dealt to several places."""
    n = F.col("n")
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(PARTNERS)).alias("n"))
    place = F.when(n > 1, F.pmod(F.xxhash64("b"), n)).otherwise(F.lit(0)).cast("int").alias("part")
    heads = counts.select(F.col("a").alias("item"), "a", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)).alias("part"), F.lit(None).cast("bigint").alias("b"))
    partners = pairs.join(counts, "a").select(F.col("b").alias("item"), "a", place, "b")
    together = heads.unionByName(partners).join(texts, "item").select("a", "part", "b", "text").repartition("a", "part").sortWithinPartitions("a", "part", "b")
    return together.mapInArrow(lambda x: _similar(x, percent), "a bigint, b bigint")


def _hung(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) -> (a, b) of each item a and the least item b that it reaches over up to ``EDGES`` edges of its task."""
    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = np.concatenate([np.stack((x.column("a").to_numpy(), x.column("b").to_numpy())) for x in held], axis=1)
        item, at = np.unique(ends, return_inverse=True)
        x, y = at.reshape(ends.shape)
        label = np.arange(len(item))
        while True:
            before = label.copy()
            low = np.minimum(label[x], label[y])
            for end in (x, y, label[x], label[y]):  # a label's own item goes on to the lesser one too
                np.minimum.at(label, end, low)
            label = label[label]
            if (label == before).all():
                break
        found = np.flatnonzero(label != np.arange(len(item)))
        return pa.RecordBatch.from_arrays([pa.array(item[found]), pa.array(item[label[found]])], names=["a", "b"])

    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= EDGES:
            yield stars(held)
            held, n = [], 0
    if n:
        yield stars(held)


def components(edges: DataFrame) -> DataFrame:
    """(item, comp) of all items on an edge (a, b); comp is the least item that it reaches.

    The edges that lie together in a task shrink to stars first; what is left of them is brought
    into as few tasks as ``EDGES`` allows and shrinks again, so few edges end at once, however many
    tasks they come from. Then alternating star steps: every
    item's larger neighbours, then all its neighbours, are hung to the least one around
    it; the edges shrink to stars in a logarithmic number of rounds. A hot centre is combined
    before its shuffle, as only a minimum is taken; the minima around the centres are written,
    so that the join with them is a broadcast or one that Spark can split."""
    def shrunk(e: DataFrame) -> DataFrame:
        e = materialise(e.select("a", "b").where("a <> b").distinct().mapInArrow(_hung, "a bigint, b bigint"), "edges")
        tasks = len(e.inputFiles())
        if tasks > 1 and tasks > (needed := max(1, -(-e.count() // EDGES))):  # as many more lie together as shrink at a time
            scattered, e = e, materialise(e.coalesce(needed).mapInArrow(_hung, "a bigint, b bigint"), "edges")
            discard(scattered)
        return e

    e = shrunk(edges)
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = materialise(both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")), "around")
        least = around.select("a", F.least("a", "low").alias("m"))
        # done when every item with a lesser neighbour has no other one: then all hang on roots
        if around.where("low < a AND high <> low").isEmpty():
            discard(e)
            return least.select(F.col("a").alias("item"), F.col("m").alias("comp"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        stars = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        old, e = e, shrunk(stars.select("x.a", "x.b"))
        discard(old)
        discard(around)


def merged(comps: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components after more edges: (item, comp) for every item on any edge so far, written."""
    if comps is None:
        return components(edges)
    found = components(edges.unionByName(comps.where("item <> comp").select(F.col("item").alias("a"), F.col("comp").alias("b"))))
    discard(comps)
    return found


def coloured(nodes: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(node, item, met, comp, n_items, leader, leader_comp), written, of nodes with items of several components.

    nodes: (node, item, met). One grouping of the rows by node, of numbers only, and one join; a hot
    node is combined before its shuffle. The leader is the item least by a hash of its id, which
    differs for every item."""
    if comps is None:
        rows = nodes.withColumn("comp", F.col("item"))
    else:
        rows = nodes.join(comps, "item", "left").withColumn("comp", F.coalesce("comp", "item"))
    rows = rows.select("node", "item", "met", "comp")
    place = F.xxhash64("item", F.lit(7))
    about = (rows.groupBy("node").agg(F.count(F.lit(1)).alias("n_items"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                      F.min_by("item", place).alias("leader"), F.min_by("comp", place).alias("leader_comp"))
             .where("c0 <> c1").select("node", "n_items", "leader", "leader_comp"))
    return materialise(rows.join(about, "node"), "coloured")


def link(items: DataFrame, nodes: DataFrame, branch, texts_of, percent: int, levels: int) -> DataFrame | None:
    """Components, (item, comp), of the items on a link; None if no two items share a node.

    items: (item, sketch, code), written; all codes or none are followed by a ``parity``. nodes: (node, item) of the first level.
    branch(node rows with sketch, level): (node, item) of their children.
    texts_of(ids): (item, text) of the wanted items, written; asked once, for the items of mixed
    first nodes, which hold those of all later ones, and deleted at the end. Other tables are deleted when
    their successors are written.

    A level takes one round of links: the pairs of its nodes' leaders, those of closest partners in
    the small nodes of the level before, and all that are left in the small nodes before that
    are verified and merged together."""
    def unmet(rows: DataFrame) -> DataFrame:
        return rows.select("node", "item", F.lit(False).alias("met"))

    fresh = coloured(unmet(nodes), None)  # nodes whose items meet their leaders next
    if fresh.isEmpty():
        return None
    codes = materialise(items.join(fresh.select("item").distinct(), "item", "left_semi").select("item", "code"), "codes")
    texts = texts_of(codes.select("item"))
    near = met = None  # small nodes whose items meet their closest partners, or all others, next
    comps = seen = None
    spent, level = [fresh], 0
    while fresh is not None or near is not None or met is not None:
        level += 1
        parts = []
        if fresh is not None:
            parts.append(star_pairs(fresh, codes, percent, seen))
        for rows, pairs_of in ((near, closest_pairs), (met, small_node_pairs)):
            if rows is not None:
                found = pairs_of(rows, codes, percent)
                parts.append(found if seen is None else found.join(seen, ["a", "b"], "left_anti"))
        pairs = parts[0]
        for more in parts[1:]:
            pairs = pairs.unionByName(more)
        pairs = materialise(pairs.distinct() if parts[1:] else pairs, "pairs")
        # a node's rows go on from fresh to near and from near to met
        held = [] if near is None else [near.select("node", "item", F.lit(True).alias("met"), "comp", "n_items")]
        held += [] if fresh is None else [fresh.select("node", "item", F.lit(False).alias("met"), "comp", "n_items")]
        if not held:
            comps = comps if pairs.isEmpty() else merged(comps, verified(pairs, texts, percent))
            break
        held = held[0].unionByName(held[-1]) if len(held) > 1 else held[0]
        if not pairs.isEmpty():
            both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))  # in either order; a pair is verified once
            seen = both if seen is None else seen.unionByName(both)
            comps = merged(comps, verified(pairs, texts, percent))
            held = coloured(held.select("node", "item", "met"), comps)
            for table in spent:
                discard(table)
            spent = [held]
        few = F.col("n_items") <= SMALL_NODE
        n_met, n_few, n_large = held.agg(F.count_if("met"), F.count_if(~F.col("met") & few), F.count_if(~F.col("met") & ~few)).first()
        met = held.where("met") if n_met else None
        near = held.where(~F.col("met") & few) if n_few else None
        large, fresh = held.where(~F.col("met") & ~few), None
        if n_large and level == levels:  # still large and mixed: compare them in slices
            cut = slices(large)
            near = cut if near is None else near.select(*cut.columns).unionByName(cut)
        elif n_large:
            fresh = coloured(unmet(branch(large.select("node", "item").join(items.select("item", "sketch"), "item"), level)), comps)
            spent.append(fresh)
    for table in (texts, codes, *spent):
        discard(table)
    return comps


def slices(nodes: DataFrame) -> DataFrame:
    """Large mixed nodes cut into small ones that still bring every two items of a node together.

    The items are dealt to groups by hash; a small node holds two groups."""
    half = SMALL_NODE // 4
    groups = nodes.withColumn("g", F.ceil(F.col("n_items") / half)).withColumn("mine", F.pmod(F.xxhash64("item", "node"), F.col("g")))
    met = groups.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("g") - 1)))
    return met.select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "item", "comp", F.lit(SMALL_NODE).cast("bigint").alias("n_items"))
