"""N-gram Jaccard join: a blocked sparse product of documents by n-grams.

A document's set holds the distinct ``n``-word shingles of its whole text
(``A-Z`` lower-cased; words are runs of ``[^\\x20\\x09-\\x0D]``); with fewer words the
whole sequence is the one shingle; without words the set is empty and linked with
nothing. Two documents link when  den * |A & B| >= num * |A | B|  (80 of 100).
The result is the classes that links span.

1. Equal sets become one node (named by a 64-bit digest of the set).
2. Linked sets of sizes x and y have sizes within num/den of each other and at least
   ceil(num/den * max(x, y)) n-grams in common. In any common order of n-grams,
   their first k common ones stand among the first  x - ceil(num/den x) + k  of
   each. Only these are entered in the incidence matrix, rare ones first: n-grams
   that several documents of one task share come last, by their counts.
3. The matrix is cut in blocks of columns. A block's task multiplies: it
   adds up, for pairs of documents within the size bound, the columns they share.
   The sums over all blocks must reach the bound k(min(x, y)), and each document
   of a pair must share so many columns with anyone: of the overlap that their sizes
   ask for, all but what can stand outside the prefix of the one that leaves out more
   (both prefixes hold the first common n-grams, up to where the first of them ends); other pairs are dropped.
4. Long columns (more than ``LONG`` documents) are not multiplied out: a few
   of a column's documents, those in most long columns first, are tried against
   the others, and then only pairs that are in different classes still and
   whose sketches allow the overlap (blocks of documents by documents, in tiles).
5. Every surviving pair is verified on its whole sets.

No link between different sets is lost: step 2 holds for all pairs, and a pair
that step 4 leaves out lies in one class already.

Defined cases: null texts count as empty, a null doc_id stands for itself and
is the smallest, repeated rows are equal sets, texts of any length are used
whole, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .prefilter import keep_by_bitmap
from .store import drop, materialize, scope

#: Documents in a column from which it is not multiplied out; products that a task adds up at a time.
LONG, ADDED = 32, 1_000_000
#: Postings in a block of columns; shingles a task counts at a time; frequent n-grams that are told to all tasks (8 bytes each and 4 for the rank).
BLOCK, COUNTED, HOT = 500_000, 1_000_000, 1 << 17
#: Documents of a long column that are tried against all others before pairs of different classes are.
STARS = 3
#: Buckets of a sketch (a power of two); documents of a long column that a task holds twice.
SKETCH, TILE = 1024, 2048
#: Documents that share a frequent n-gram, from which its column is dealt to several blocks.
SPLIT = 200_000
_LOW = -(1 << 63)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words, each computed once while the table is small."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000:
            self[word] = h
        return h


_words = _Words()


def shingles(text: str, n: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of a text's set."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    m = len(words)
    if not m:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, m)
    size = min(n, m)
    h = np.full(m - size + 1, size, np.uint64)
    for i in range(size):
        h = (h ^ w[i : m - size + 1 + i]) * _ODD[i % 8]
        h ^= h >> np.uint64(29)
    return np.unique(_mix(h))


def digest(s: np.ndarray) -> int:
    """A set's node: a signed 64-bit digest."""
    folded = np.array([s.sum(dtype=np.uint64), len(s)], np.uint64) * _ODD[:2]
    total = folded[:1] ^ folded[1:] ^ np.bitwise_xor.reduce(_mix(s * _ODD[2]))
    return int(_mix(total).view(np.int64)[0])


def need(size: int, num: int, den: int) -> int:
    """Least overlap with any partner of a set of this size."""
    return -(-num * size // den)


def first_common(size):
    """k: as many n-grams must two prefixes share, for the smaller set's size."""
    return 1 + size // 25


def _texts(batches: Iterator[pa.RecordBatch], *names: str):
    for batch in batches:
        for k in range(0, len(batch), 128):
            some = batch.slice(k, 128)
            yield from zip(*(some[x].to_pylist() for x in names))


def _table(rows, names, types, every: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == every:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """(key, node, size) of every document, with warm n-grams on the side: rows
    of kind 1 hold an n-gram that different sets of one task share, and its count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, total, seen = [], 0, set()

            def counted():
                h, c = np.unique(np.concatenate(held), return_counts=True)
                yield from ((1, a, b, 0) for a, b in zip(h[c > 1].view(np.int64).tolist(), c[c > 1].tolist()))

            for key, text in _texts(batches, "key", "text"):
                s = shingles(text, n)
                node = digest(s)
                yield 0, key, node, len(s)
                if len(s) and node not in seen:
                    seen.add(node)
                    held.append(s)
                    total += len(s)
                    if total > COUNTED:
                        yield from counted()
                        held, total, seen = [], 0, set()
            if held:
                yield from counted()

        yield from _table(rows(), ["kind", "a", "b", "size"], [pa.int32(), pa.int64(), pa.int64(), pa.int64()])

    return rows.mapInArrow(run, "kind int, a long, b long, size long")


def _incidence(rows: DataFrame, n: int, num: int, den: int, hot: np.ndarray, count: np.ndarray, blocks: int) -> DataFrame:
    """Blocks of the incidence matrix: (block, columns, nodes, sizes), packed."""
    spark = rows.sparkSession
    by_value = np.argsort(hot)
    told = spark.sparkContext.broadcast((hot[by_value], by_value.astype(np.uint32), (1 + count[by_value] // SPLIT).astype(np.uint64)))  # HOT entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank, parts = told.value
        held, total, seen = [], 0, set()

        def flush():
            h = np.concatenate([x[0] for x in held])
            lens = [len(x[0]) for x in held]
            node = np.repeat(np.array([x[1] for x in held], np.int64), lens)
            size = np.repeat(np.array([x[2] for x in held], np.uint32), lens)
            salt = np.zeros(len(h), np.uint64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                wide = (hot[at] == h) & (parts[at] > 1)
                salt[wide] = _mix(node[wide].view(np.uint64)) % parts[at][wide]
            block = ((_mix(h ^ _ODD[3]) + salt) % np.uint64(blocks)).astype(np.int64)
            order = np.lexsort((h, block))
            cuts = np.searchsorted(block[order], np.arange(blocks + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                o = order[cuts[b] : cuts[b + 1]]
                yield pa.RecordBatch.from_arrays([pa.array([int(b)], pa.int32()), *(pa.array([x[o].tobytes()], pa.binary()) for x in (h, node, size))], ["block", "h", "node", "size"])

        for (text,) in _texts(batches, "text"):
            s = shingles(text, n)
            if not len(s):
                continue
            node = digest(s)
            if node in seen:
                continue
            seen.add(node)
            p = len(s) - need(len(s), num, den) + first_common(len(s))
            if len(hot):
                at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                is_hot = hot[at] == s
                last = s[is_hot][np.argsort(rank[at[is_hot]])]
                prefix = np.concatenate([s[~is_hot], last])[:p]
            else:
                prefix = s[:p].copy()
            held.append((prefix, node, len(s)))
            total += p
            if total > BLOCK:
                yield from flush()
                held, total, seen = [], 0, set()
        if held:
            yield from flush()

    return rows.select("text").mapInArrow(run, "block int, h binary, node binary, size binary")


def _multiply(incidence: DataFrame, blocks: int, num: int, den: int, wide: np.ndarray) -> DataFrame:
    """Overlap counts within blocks: kind 0 (a, b, sizes, shared columns); kind 1: entries of long columns (a: column, b: node); kind 2: columns that a document (a) shares with any other (b)."""
    told = incidence.sparkSession.sparkContext.broadcast(np.sort(wide))  # part of the HOT entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, node, size = [], [], []
        for batch in batches:
            for parts, kind, name in ((h, np.uint64, "h"), (node, np.int64, "node"), (size, np.uint32, "size")):
                parts += [np.frombuffer(x, kind) for x in batch[name].to_pylist()]
        if not h:
            return
        h, node, size = np.concatenate(h), np.concatenate(node), np.concatenate(size).astype(np.int64)
        order = np.argsort(h, kind="stable")
        h, node, size = h[order], node[order], size[order]
        wide = told.value
        split = np.isin(h, wide) if len(wide) else np.zeros(len(h), bool)
        twice = np.zeros(len(h), bool)
        same = h[1:] == h[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        keep = twice | split
        h, node, size, split = h[keep], node[keep], size[keep], split[keep]
        order = np.lexsort((node, size, h))
        h, node, size, split = h[order], node[order], size[order], split[order]
        fresh = np.ones(len(h), bool)  # a node comes from several tasks where its copies are
        fresh[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
        h, node, size, split = h[fresh], node[fresh], size[fresh], split[fresh]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        length = np.repeat(np.diff(np.append(start, len(h))), np.diff(np.append(start, len(h))))
        some = (length > 1) | split
        h, node, size, split, length = h[some], node[some], size[some], split[some], length[some]
        far = (length > LONG) | split
        names = ["kind", "a", "b", "na", "nb", "shared"]
        who, times = np.unique(node, return_counts=True)
        for k in range(0, len(who), 65536):
            i, c = who[k : k + 65536], times[k : k + 65536]
            z = np.zeros(len(i), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.int32) + 2), pa.array(i), pa.array(c), pa.array(z), pa.array(z), pa.array(z)], names)
        for k in range(0, int(far.sum()), 65536):
            i = np.flatnonzero(far)[k : k + 65536]
            z = np.zeros(len(i), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.int32) + 1), pa.array(h[i].view(np.int64)), pa.array(node[i]), pa.array(z), pa.array(size[i]), pa.array(z)], names)
        h, node, size = h[~far], node[~far], size[~far]
        held, products = [], 0

        def added():
            """Sums of what is held; those of one pair may come in several rows."""
            a, b, na, nb = (np.concatenate(x) for x in zip(*held))
            swap = a > b
            a[swap], b[swap], na[swap], nb[swap] = b[swap], a[swap], nb[swap], na[swap]
            order = np.lexsort((b, a))
            a, b, na, nb = a[order], b[order], na[order], nb[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            shared = np.diff(np.append(new, len(a)))
            for k in range(0, len(new), 65536):
                i, c = new[k : k + 65536], shared[k : k + 65536]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(i), np.int32)), *(pa.array(x) for x in (a[i], b[i], na[i], nb[i], c))], names)

        for d in range(1, LONG):
            if len(h) <= d:
                break
            i = np.flatnonzero((h[d:] == h[:-d]) & (den * size[:-d] >= num * size[d:]))  # sizes rise within a column
            if len(i):
                held.append((node[i], node[i + d], size[i], size[i + d]))
                products += len(i)
            elif not (h[d:] == h[:-d]).any():
                break
            if products > ADDED:
                yield from added()
                held, products = [], 0
        if held:
            yield from added()

    dealt = incidence.repartitionById(blocks, F.col("block"))
    return dealt.mapInArrow(run, "kind int, a long, b long, na long, nb long, shared long")


def _fetch(wanted: DataFrame, rows: DataFrame, n: int, make, schema: str) -> DataFrame:
    """(node, value) of nodes ``wanted`` (node, key); ``make`` turns a set into the value, bytes.
    Only texts that a bitmap of fixed size does not rule out are moved."""
    near = keep_by_bitmap(rows, F.col("key"), wanted.select("key")).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for node, text in _texts(batches, "node", "text"):
                s = shingles(text, n)
                if digest(s) == node:
                    yield node, make(s)

        yield from _table(each(), schema.replace(" long", "").replace(" binary", "").split(", "), [pa.int64(), pa.binary()], 512)

    return near.join(wanted, "key").select("node", "text").mapInArrow(run, schema).dropDuplicates(["node"])


def sketch(s: np.ndarray) -> bytes:
    """Counts of a set's n-grams in ``SKETCH`` buckets (255 stands for more): the sum of
    the lesser counts of two sets is never below their overlap."""
    return np.minimum(np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), 255).astype(np.uint8).tobytes()


def _across(own: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of documents of one long column and different classes that their
    sizes, shared columns and sketches allow to link. Columns are dealt in tiles of
    ``TILE`` documents, a task has two tiles at most, and only surviving pairs leave it."""
    tiles = own.groupBy("h").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = own.join(sketches, "node").join(tiles, "h").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(F.least("tile", j).alias("i"), F.greatest("tile", j).alias("j")))
    dealt = dealt.withColumn("pair", F.explode(others)).select("h", "pair.i", "pair.j", "tile", "node", "component", "size", "s", "sketch")

    def run(t: pa.Table) -> pa.Table:
        tile, node, comp, size, s, i, j = (t[c].to_numpy() for c in ("tile", "node", "component", "size", "s", "i", "j"))
        sk = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(node), -1)
        full = (sk == 255).any(1)
        outside = -(-num * size // den) - first_common(size)
        first, second = np.flatnonzero(tile == i[0]), np.flatnonzero(tile == j[0])
        a, b = [], []
        for x in first:
            y = second[node[second] > node[x]] if i[0] == j[0] else second
            lo, hi = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            y = y[(comp[y] != comp[x]) & (lo * den >= hi * num)]
            y = y[np.minimum(s[x], s[y]) + np.maximum(outside[x], outside[y]) >= -(-(size[x] + size[y]) * num // (num + den))]
            for k in range(0, len(y), 1024):
                z = y[k : k + 1024]
                least = np.minimum(sk[x], sk[z]).sum(1, dtype=np.int64)
                z = z[(least >= -(-(size[x] + size[z]) * num // (num + den))) | full[x] | full[z]]
                a += [node[x]] * len(z)
                b += node[z].tolist()
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.groupBy("h", "i", "j").applyInArrow(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, rows: DataFrame, ids: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The links (a, b) among ``pairs``, on whole sets. ``ids``: (node, key), a document for each node."""
    with scope(pairs.sparkSession) as results:
        pairs = materialize(pairs, "pairs")
        wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(ids, "node"), "wanted")
        found = materialize(_fetch(wanted, rows, n, np.ndarray.tobytes, "node long, s binary"), "sets")

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                for a, b, x, y in _texts(batches, "a", "b", "x", "y"):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if den * common >= num * (len(x) + len(y) - common):
                        yield a, b

            yield from _table(each(), ["a", "b"], [pa.int64(), pa.int64()])

        both = pairs.join(found.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(found.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
        results.append(out := materialize(both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), "links"))
    return out


def jaccard_classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    with scope(docs.sparkSession) as results:
        rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
        first = materialize(_sets(rows, n), "sets")
        members = first.filter("kind = 0").select(F.col("a").alias("key"), F.col("b").alias("node"), "size")
        hot = first.filter("kind = 1").groupBy(F.col("a").alias("h")).agg(F.sum("b").alias("c")).filter("c > 3").orderBy(F.desc("c"), "h").limit(HOT).toArrow()
        value, count = (hot[c].to_numpy()[::-1].astype(np.int64) for c in ("h", "c"))  # the most frequent come last
        value = value.view(np.uint64)
        total = members.agg(F.sum("size")).first()[0] or 0
        blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total * (den - num + 4) // den // BLOCK))
        product = materialize(_multiply(_incidence(rows, n, num, den, value, count, blocks), blocks, num, den, value[count >= SPLIT]), "product")

        k = F.lit(1) + F.floor(F.least("na", "nb") / 25)
        shares = materialize(product.filter("kind = 2").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("s")), "shares")
        prefix_k = lambda x: F.lit(1) + F.floor(x / 25)

        def reach(s: Column, own: Column, other: Column) -> Column:
            """Whether a document's columns shared with anyone allow for the overlap with one of the other size."""
            overlap = F.ceil((own + other) * num / (num + den) - 1e-9)
            outside = lambda x: F.ceil(x * num / den - 1e-9) - prefix_k(x)
            return s >= overlap - F.greatest(outside(own), outside(other))

        short = product.filter("kind = 0").groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared")).filter(F.col("shared") >= k)
        for x, y in (("a", "b"), ("b", "a")):
            short = short.join(shares.select(F.col("node").alias(x), F.col("s").alias(f"s{x}")), x).filter(reach(F.col(f"s{x}"), F.col(f"n{x}"), F.col(f"n{y}")))
        short = short.select("a", "b")
        ids = members.filter("size > 0").groupBy("node").agg(F.min("key").alias("key"))
        verified = lambda pairs: _verify(pairs, rows, ids, n, num, den)
        links = verified(short)
        classes = connected_components(links)

        entries = product.filter("kind = 1").select(F.col("a").alias("h"), F.col("b").alias("node"), F.col("nb").alias("size")).distinct()
        # the document found in most long columns is likely the one that others are copies of
        degree = entries.groupBy("node").agg(F.count("*").alias("degree"))
        open_ = materialize(entries.join(degree, "node").join(shares, "node"), "entries")


        def fits(p: str, q: str) -> Column:
            m, n = F.col(f"{p}.size"), F.col(f"{q}.size")
            return (F.least(m, n) * den >= F.greatest(m, n) * num) & reach(F.col(f"{p}.s"), m, n) & reach(F.col(f"{q}.s"), n, m)

        for attempt in range(STARS + 1):
            before = open_
            if open_.isEmpty():
                break
            own = open_.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
            mixed = own.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("h")
            own = materialize(own.join(mixed, "h"), "open")
            if own.isEmpty():
                break
            x = own.alias("x")
            if attempt == STARS:
                wanted = materialize(own.select("node").distinct().join(ids, "node"), "wanted")
                pairs = _across(own, _fetch(wanted, rows, n, sketch, "node long, sketch binary"), num, den)
            else:  # each column's next document, against those not in its class
                tried = materialize(own.groupBy("h").agg(F.max_by(F.struct("node", "size", "component", "s"), F.struct("degree", "node")).alias("y")), "tried")
                y = tried.select("h", F.col("y.node").alias("node"), F.col("y.size").alias("size"), F.col("y.component").alias("component"), F.col("y.s").alias("s")).alias("y")
                across = (F.col("x.h") == F.col("y.h")) & (F.col("x.component") != F.col("y.component")) & fits("x", "y")
                pairs = x.join(y, across).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
            more = verified(pairs)
            grown = materialize(links.unionByName(more), "links")
            drop(links, more, classes)
            links, classes = grown, connected_components(grown)
            if attempt < STARS:
                led = tried.select("h", F.col("y.node").alias("node"), F.lit(-attempt - 1).cast("long").alias("used"))
                open_ = own.drop("component").join(led, ["h", "node"], "left").withColumn("degree", F.coalesce("used", "degree")).drop("used")
                last, open_ = before, materialize(open_, "entries")
                drop(last, own, tried)

        named = members.join(classes, "node", "left").withColumn("component", F.when(F.col("size") > 0, F.coalesce("component", "node")))
        least = named.filter("size > 0").groupBy("component").agg(F.min("key").alias("least"))
        out = named.join(least, "component", "left")
        real = lambda c: F.nullif(F.col(c), F.lit(_LOW))
        results.append(out := out.select(real("key").alias("doc_id"), F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, real("least")).otherwise(real("key")).alias("component_id")))
    return out
