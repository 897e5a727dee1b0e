"""Near-duplicate groups by MinHash bands, odd sketches and exact verification.

1. Every text becomes the set of its word shingles; equal sets are one node
   (grouped by a 128-bit digest, combined before the shuffle).
2. A node has MinHash values in bands of ``ROWS``; as many bands as make the
   chance that a linked pair shares none at most ``MISS``. Its odd sketch folds
   further MinHash samples (the least hash of each of ``SAMPLES`` bins) into a
   bitmap by parity: the set bits of the XOR of two sketches estimate how many
   samples differ, and a pair beyond the limit is no candidate. (Bitmaps of
   sets beyond some 9,000 shingles fill up and then exclude nothing.)
3. In each band bucket every node is paired with two centers only: the smallest
   node and one that a hash of node and bucket chooses, so that a group of near
   copies has other centers in its other buckets. The pairs that pass size and
   sketch are verified on the full sets.
4. Verified links make components (alternating stars). In a bucket whose nodes
   are not yet one component, the nodes outside its largest component are
   compared with all that lie in other components. Both sides are dealt into
   pieces of about ``PIECE`` rows, and Spark deals the pairs of pieces over its
   tasks, where numpy compares the sketches; a pair is taken in the first bucket
   that both share, once, and verified as well. So pairs inside a component are
   never listed, and no link between components is missed. The links found then
   join components, not nodes.

Defined cases: a null or empty text, or one without words, has the empty set
and is linked with nothing; with fewer words than a shingle the whole sequence
is one shingle; equal texts always share a component; every row's text counts
on its own, also where rows share an id; rows without an id are linked like all
others, but name no component: ``component_id`` is the smallest id in it, null
if it has none; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtally.llm.common import text_bytes, written

SHINGLE = 5
PERCENT = 80
ROWS = 4
MISS = 1e-7
SAMPLES = 1 << 14
SKETCH_LONGS = 32
PIECE = 1024

_U = np.uint64


def bands_for(percent: int) -> int:
    """Bands needed so that a pair at the limit shares none with a chance of at most ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingles(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size))))


def linked(a: set, b: set, percent: int) -> bool:
    if not a or not b:
        return False
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Signer:
    """Set size, digest, band keys and odd sketch of texts."""

    def __init__(self, size: int, bands: int):
        self.size, self.bands = size, bands
        seeds = _mixed(np.arange(1, 2 * bands * ROWS + 1, dtype=_U))
        self.factor, self.shift = seeds[::2] | _U(1), seeds[1::2]
        self.known: dict[bytes, int] = {}

    def hashes(self, text: bytes) -> np.ndarray:
        """Distinct 64-bit hashes of the shingles."""
        words = words_of(text)
        if not words:
            return np.zeros(0, _U)
        if len(self.known) > 500_000:
            self.known.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        each = np.array([known[w] for w in words], _U)
        n = len(each) - self.size + 1
        span = self.size if n > 0 else len(each)
        n = max(n, 1)
        joint = np.full(n, span, _U)
        for i in range(span):
            joint = _mixed(joint * _U(0x9E3779B97F4A7C15) + each[i:i + n])
        return np.unique(joint)

    def __call__(self, text: bytes) -> tuple[int, bytes | None, list[int], list[int]]:
        h = self.hashes(text)
        if not len(h):
            return 0, None, [], []
        least = np.full(self.bands * ROWS, ~_U(0))
        for low in range(0, len(h), 1024):
            part = h[low:low + 1024, None] * self.factor + self.shift
            np.minimum(least, (part ^ (part >> _U(29))).min(axis=0), out=least)
        key = np.arange(self.bands, dtype=_U)
        for r in range(ROWS):
            key = _mixed(key * _U(0x9E3779B97F4A7C15) + least[r::ROWS])
        return len(h), xxhash.xxh3_128_digest(h.tobytes()), key.view(np.int64).tolist(), self.sketch(h).tolist()

    @staticmethod
    def sketch(h: np.ndarray) -> np.ndarray:
        """Odd sketch of a set of hashes: the least hash of each occupied bin flips one bit."""
        other = _mixed(h + _U(0x2545F4914F6CDD1D))
        other = np.sort((other % _U(SAMPLES) << _U(48)) | (other >> _U(16)))
        bins = other >> _U(48)
        sample = other[np.concatenate([[True], bins[1:] != bins[:-1]])]
        bit = (_mixed(sample) % _U(64 * SKETCH_LONGS)).astype(np.int64)
        odd = np.bincount(bit, minlength=64 * SKETCH_LONGS) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """doc_id, own (md5 of the text), n_shingles, digest, bands, sketch of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(size, bands)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                made = [signer(t) for t in text_bytes(part.column(2))]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array([m[i] for m in made], k)
                                       for i, k in enumerate((pa.int64(), pa.binary(), longs, longs)))],
                    names=["doc_id", "own", "n_shingles", "digest", "bands", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _own(F.col("text")).alias("own"), "text")
    return rows.mapInArrow(sign, "doc_id long, own binary, n_shingles long, digest binary, bands array<long>, sketch array<long>")


def _own(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


#: the functions of ``sketch_limit``, on columns and on arrays
_COLUMNS = SimpleNamespace(least=F.least, greatest=F.greatest, exp=F.exp, sqrt=F.sqrt, log=F.log, number=F.lit)
_ARRAYS = SimpleNamespace(least=np.minimum, greatest=np.maximum, exp=np.exp, sqrt=np.sqrt, log=np.log, number=float)


def _most(mean, on):
    """A count that a sum of rare events with this mean exceeds with a chance of at most ``MISS``.

    Chernoff's bound for Poisson counts, which holds for small means too: the
    k with k ln(k / mean) - k + mean = -ln(MISS). Bernstein's bound lies above
    it, and a step of Newton's from there comes nearer without passing it.
    """
    need = -math.log(MISS)
    most = mean + need / 3 + on.sqrt(need * need / 9 + 2 * need * mean)
    return (most - mean + need) / on.log(most / mean)


def sketch_limit(a, b, percent: int, on=_COLUMNS):
    """Set bits that the XOR of the sketches of a linked pair of sets of these sizes may have.

    Linked sets differ in at most ``gap`` elements, and a sample differs only
    if its bin holds one of these; in sets larger than the bins the share of
    differing samples is that of the sets, give or take 6 deviations. A
    differing sample flips one bit, or two where its bin is occupied in both
    sets: rare in small sets, so their number is bounded by ``_most``, and by
    the differing samples. Bits that are flipped twice only lower the count.

    ``a`` and ``b`` are columns, or arrays with ``on`` set to ``_ARRAYS``.
    """
    share = percent / 100
    union = (a + b) * 100 / (100 + percent)
    gap = (a + b) * (100 - percent) / (100 + percent)  # exact where it is a whole number
    samples = SAMPLES * (1 - on.exp(-union / SAMPLES))
    differ = on.least(gap, samples * (1 - share) + 6 * on.sqrt(samples * (share * (1 - share))) + 4)
    # at least the chance that the other set has the bin; without exp, as it is computed for each pair
    both = on.least(on.number(1.0), on.greatest(a, b) * -math.log1p(-1 / SAMPLES))
    # at 100 percent nothing differs: the mean stays above 0 for the logarithm
    flips = differ + on.least(differ, _most(on.greatest(gap * both, on.number(1e-9)), on))
    bits = 64 * SKETCH_LONGS
    return on.least(flips, bits / 2 * (1 - on.exp(-2 * flips / bits)) + 3 * math.sqrt(bits))


def _xor_bits(a: Column, b: Column) -> Column:
    counts = [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(SKETCH_LONGS)]
    return sum(counts[1:], counts[0])


def _likely(a: str, b: str, percent: int) -> Column:
    """Whether size and sketch of two nodes (structs ``a`` and ``b``) allow a link."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    return sizes & (_xor_bits(F.col(f"{a}.sketch"), F.col(f"{b}.sketch")) <= sketch_limit(n_a, n_b, percent))


def _with_nodes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the size and sketch of both as structs x and y."""
    one = nodes.select(F.col("node").alias("a"), F.struct("n", "sketch").alias("x"))
    two = nodes.select(F.col("node").alias("b"), F.struct("n", "sketch").alias("y"))
    return pairs.join(one, "a").join(two, "b")


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are linked; ``texts`` has node, text."""
    one = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    two = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(one, "b").join(two, "a").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, set()
        for batch in batches:
            good = []
            for a, b in zip(text_bytes(batch.column(2)), text_bytes(batch.column(3))):
                if a != last:
                    last, kept = a, shingles(words_of(a), size)
                good.append(linked(kept, shingles(words_of(b), size), percent))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(check, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of every node of ``edges`` (a, b), by alternating stars."""
    stars = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    mark = None
    while True:
        # large star: each neighbour above a node to the smallest of its neighbourhood
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node and its smaller neighbours to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return stars.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _stars(buckets: DataFrame) -> DataFrame:
    """Each node with the centers of its buckets, as pairs a < b."""
    stars = buckets.select("node", F.explode("centers").alias("center")).where("node != center")
    return stars.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()


def _dealt(buckets: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the buckets with several components, once or more per side, as units (key, i, j) of bounded size.

    On the left a bucket has its nodes outside its largest component (``main``), in pieces i;
    on the right all its nodes, in pieces j. Each piece stands in the units with all of the other side.
    """
    placed = _labelled(buckets, labels)
    counts = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("rows"))
    main = counts.groupBy("key").agg(
        F.max_by("label", F.struct("rows", "label")).alias("main"), F.count(F.lit(1)).alias("labels"),
        F.sum("rows").alias("all"), (F.sum("rows") - F.max("rows")).alias("outside"))
    main = main.where("labels > 1").select("key", "main", *[F.ceil(F.col(c) / PIECE).cast("long").alias(c) for c in ("all", "outside")])
    open_ = written(placed.join(main, "key").join(nodes, "node"), "open")

    def side(rows: DataFrame, number: int, own: str, pieces: str, other: str, others: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias(other)
        piece = F.pmod(F.xxhash64("node", F.lit(number)), F.col(pieces)).alias(own)
        out = rows.select("key", piece, every, F.lit(number).alias("side"), "main", "label", "node", "n", "sketch", "bands")
        return out.select("key", "i", "j", "side", "main", "label", "node", "n", "sketch", "bands")

    left = side(open_.where("label != main"), 0, "i", "outside", "j", "all")
    return left.unionByName(side(open_, 1, "j", "all", "i", "outside"))


def _remaining(buckets: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Likely pairs that share a bucket and lie in different components."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            a, b = _met(rows, percent)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    unit = ["key", "i", "j"]
    dealt = _dealt(buckets, nodes, labels).repartition(*unit).sortWithinPartitions(*unit)
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each unit, from batches in which the rows of a unit follow each other."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        rows = _arrays(table, ("key", "i", "j"))
        cuts = np.flatnonzero((rows["key"][1:] != rows["key"][:-1]) | (rows["i"][1:] != rows["i"][:-1]) | (rows["j"][1:] != rows["j"][:-1])) + 1
        if len(cuts):
            rows = _arrays(table.slice(0, int(cuts[-1])), table.column_names)
            for low, high in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
                yield {name: column[low:high] for name, column in rows.items()}
        held = table.slice(int(cuts[-1])) if len(cuts) else table
    if held is not None and held.num_rows:
        yield _arrays(held, held.column_names)


def _arrays(table: pa.Table, names) -> dict[str, np.ndarray]:
    """Number columns as arrays, columns of equally long lists as matrices."""
    out = {}
    for name in names:
        column = table.column(name).combine_chunks()
        nested = pa.types.is_list(column.type)
        flat = (column.flatten() if nested else column).to_numpy(zero_copy_only=False)
        out[name] = flat.reshape(len(column), -1) if nested else flat
    return out


def _met(rows: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The likely pairs (left node, right node) of a unit for which its bucket is the first that both share."""
    left, right = np.flatnonzero(rows["side"] == 0), np.flatnonzero(rows["side"] == 1)
    node, label, n = rows["node"], rows["label"], rows["n"]
    main = rows["main"][0]
    apart = label[left][:, None] != label[right]
    apart &= (label[right] == main) | (node[left][:, None] < node[right])
    few, many = np.minimum(n[left][:, None], n[right]), np.maximum(n[left][:, None], n[right])
    x, y = np.nonzero(apart & (few * 100 >= many * percent))
    x, y = left[x], right[y]
    found = [np.zeros(0, np.int64)] * 2
    sketch, bands = rows["sketch"].view(_U), rows["bands"]
    for low in range(0, len(x), 1 << 15):  # 8 MB of sketches at a time
        a, b = x[low:low + (1 << 15)], y[low:low + (1 << 15)]
        bits = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
        good = bits <= sketch_limit(n[a], n[b], percent, _ARRAYS)
        a, b = a[good], b[good]
        # components that differ differ in all buckets that they share, so the first one has the pair
        first = (bands[a] == bands[b]).argmax(axis=1)
        here = bands[a, first] == rows["key"][0]
        found = [np.concatenate([old, node[new[here]]]) for old, new in zip(found, (a, b))]
    return found[0], found[1]


def _found(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, own, n_shingles, digest, label of every row, and of its component (by label) the first row: id, text."""
    signed = written(signatures(docs, size, bands_for(percent)), "signatures")
    # one row stands for all of a digest
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")
    groups = signed.where("n_shingles > 0").groupBy("digest").agg(
        F.min(row).alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    groups = written(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")
    nodes = groups.select("node", "n", "sketch")
    buckets = groups.select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(
        F.array(F.min("node"), F.min_by("node", F.xxhash64("key", "node"))).alias("centers"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    buckets = written(buckets.join(shared, "key").select("key", "node", "centers").distinct(), "buckets")
    pairs = written(_with_nodes(_stars(buckets), nodes).where(_likely("x", "y", percent)).select("a", "b").distinct(), "pairs")
    # the texts of all nodes that share a bucket, fetched once, each from the row that stands for it
    wanted = groups.join(buckets.select("node").distinct(), "node").select("node", "row.doc_id", "row.own")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), _own(F.col("text")).alias("key"), "text")
    texts = texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("own")))
    texts = written(texts.select("node", "text").distinct(), "texts")
    links = written(verified(pairs, texts, size, percent), "links")
    labels = written(components(links), "labels")
    rest = _remaining(buckets.select("key", "node"), groups.select("node", "n", "sketch", "bands"), labels, percent)
    more = written(verified(written(rest.join(pairs, ["a", "b"], "left_anti"), "pairs"), texts, size, percent), "links")
    found = _labelled(groups.select("row", "digest", "node"), labels)
    if more.limit(1).count():
        ends = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
        joined = more.join(ends, "a", "left").join(ends.select(F.col("a").alias("b"), F.col("x").alias("y")), "b", "left")
        whole = written(components(joined.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))), "labels")
        whole = whole.select(F.col("node").alias("label"), F.col("label").alias("whole"))
        found = found.join(whole, "label", "left").withColumn("label", F.coalesce("whole", "label"))
    first = found.groupBy("label").agg(F.min("row").alias("first"))
    found = written(found.join(first, "label").select("digest", "label", "first"), "found")
    return signed.select("doc_id", "own", "n_shingles", "digest").join(found, "digest", "left")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, digest, component_id, kept of every row.

    Links texts with ``100 * common >= percent * all`` shingles of ``size`` words.
    """
    out = _found(docs, size, percent)
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    out = out.select("doc_id", "n_shingles", "digest", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their group, in its columns.

    Of each component the row with the smallest id stays (one without an id
    only where none has one; of several texts under that id the one with the
    least md5); of rows with the same id and text one. Rows are judged by their
    id and text, so a text that is no copy stays whatever else its id has.
    """
    names = docs.columns
    found = _found(docs, size, percent)
    stays = F.col("label").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("own") == F.col("first.own")))
    kept = found.where(stays).select(F.col("doc_id").alias("nd_id"), F.col("own").alias("nd_own")).distinct()
    mine = docs.withColumns({"nd_doc": F.col("doc_id").cast("long"), "nd_text": _own(F.col("text"))})
    rest = mine.join(kept, F.col("nd_doc").eqNullSafe(F.col("nd_id")) & (F.col("nd_text") == F.col("nd_own")), "left_semi")
    return rest.dropDuplicates(["nd_doc", "nd_text"]).select(*[F.col(f"`{n}`") for n in names])
