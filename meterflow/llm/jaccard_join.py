"""N-gram Jaccard self-join by adaptive multi-match prefixes, and its components.

A text's set is its distinct 5-word shingles, as 64-bit hashes. Equal sets are
one class from the start, so exact copies never meet in pairs. In one global
order, rare shingles first, two sets that reach the similarity share at least l
shingles among the first ``size - ceil(0.8 size) + l`` of each, for every l
(the smaller of the two sets' l where they differ). Each set picks its l by the estimated
cost of the candidates its prefix brings: a longer prefix, more matches asked.
A shingle that occurs once in the corpus matches nothing and isn't indexed.
Where a set is the smaller of a pair, ``size - ceil(8/9 size) + l`` shingles do: the larger one is no smaller.

Three exact bounds drop pairs early, given the intersection a pair of their sizes needs: the fewer of
the shingles that occur elsewhere; for each match, the shingles before and after it in both sets; and the matches
with what lies behind the prefixes.

The order comes from document frequencies, counted over all texts and kept as
levels in a fixed table of slots by hash, which every task gets. A slot shared
by several shingles only costs candidates: any order is exact, as long as it is one.
A large corpus fills every slot, and then all of a prefix looks shared. So the prefixes' own shingles are counted again,
first of all texts and then of the distinct sets, and those that only one has, which match nothing, go before anything is indexed.

Hashes of whole sets are not stored, which took more than the texts do: for the pairs that are verified they
are made again from the texts, found by a table of bits of their digests. Tables and shuffle files that nothing reads
any more are deleted on the way.

Candidates meet per indexed shingle. First every set is compared with the leader
of its shingles' groups and linked sets get one label, so a large group of near
copies costs a comparison per member, not per pair. The first leader is the set with the most
frequent shingles, what a group's copies were made from; later ones are drawn. Then all pairs of sets that
share a shingle, have different labels and enough matches are verified: no link
between two components is lost, and pairs inside one are never made.

Defined cases: words are split at space and tab to carriage return, A-Z in lower
case; a text of 1 to 4 words is one shingle, its whole sequence; null text, or
one without words, has no shingle and is its own component; a null identifier
is larger than any other; repeated rows have one set; an empty table gives no
row; other columns are ignored, and kept by ``drop_near``, which decides per identifier and text.
"""

from __future__ import annotations

import math
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import passing, remove, save, shared_dir, shuffles_freed
from .components import connect

N, NUM, DEN = 5, 80, 100          # words of a shingle; the similarity NUM / DEN
SLOT_BITS = 26                    # the frequency table: 2**SLOT_BITS slots of 4 bits at most, fewer for small corpora
MARK_BITS = 28                    # a table of bits that says which hashes were met: 2**MARK_BITS of them at most
FOLD = 1 << 20                    # hashes that are folded at a time
MATCHES = (1, 2, 3, 4, 6, 8, 12, 16)


# Words are hashed where they stand in a block of bytes: a word's hash is the sum of its bytes' values times rising
# powers of an odd number, modulo 2**64, read off a running sum over the block; dividing by the first power frees it of its place.
_VALUES = np.random.default_rng(5).integers(1, 2 ** 64, 256, np.uint64)
_VALUES[ord("A"):ord("Z") + 1] = _VALUES[ord("a"):ord("z") + 1]
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SPLIT = re.compile(rb"[\x20\x09-\x0D]")
_STEP = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Hashes of a text's shingles, from its UTF-8 bytes; blocks end between words, so a word is never cut."""

    def __init__(self, block: int = 1 << 20):
        self.block, self.up, self.down = block, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def _words(self, data: bytes) -> np.ndarray:
        code = np.frombuffer(data, np.uint8)
        if len(code) >= len(self.up):
            n = 2 * len(code) + 1
            self.up, self.down = _powers(_STEP, n), _powers(pow(_STEP, -1, 2 ** 64), n)
        inside = np.zeros(len(code) + 2, np.int8)
        inside[1:-1] = ~_SPACE[code]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        running = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(_VALUES[code] * self.up[:len(code)], out=running[1:])
        h = (running[ends] - running[starts]) * self.down[starts]
        return h ^ (h >> np.uint64(32))

    def words(self, data: bytes) -> np.ndarray:
        if len(data) <= self.block:
            return self._words(data)
        out, at = [], 0
        while at < len(data):
            cut = _SPLIT.search(data, at + self.block)
            end = cut.start() if cut else len(data)
            out.append(self._words(data[at:end]))
            at = end
        return np.concatenate(out)

    def __call__(self, data: bytes | None, distinct: bool = True) -> np.ndarray:
        h = self.words(data) if data else np.zeros(0, np.uint64)
        if not len(h):
            return h
        n = min(N, len(h))
        code = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            code = (code ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        code ^= code >> np.uint64(32)
        return np.unique(code) if distinct else code


def _shingles():
    make = Shingler()

    def run(batch):
        for at in range(0, batch.num_rows, 256):
            for t in batch.column(0)[at:at + 256].cast(pa.binary()).to_pylist():
                yield make(t, distinct=False)   # a repeat within a text may only cost a candidate
    return run


def _numbers():
    """Longs, or lists of them, as they stand."""
    def run(batch):
        for at in range(0, batch.num_rows, 1024):
            column = batch.column(0)[at:at + 1024]
            values = column.flatten() if pa.types.is_list(column.type) else column.drop_null()
            yield values.to_numpy(zero_copy_only=False).view(np.uint64)
    return run


def _fingerprints(bits: int, hashes):
    """Rows (range, blob, more): the top ``bits`` of each hash, the next 32 of all that share them, each once,
    and pairs (those 32, times beyond the first) of the ones met more often. ``hashes()(batch)``: arrays of them."""
    def run(batches):
        arrays, held, size = hashes(), [], 0

        def flushed():
            h = np.concatenate(held)
            held.clear()
            h >>= np.uint64(32 - bits)
            h.sort()
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            h, beyond = h[starts], np.minimum(np.diff(np.r_[starts, len(h)]) - 1, (1 << 32) - 1).astype(np.uint32)
            span, print32 = (h >> np.uint64(32)).astype(np.int64), h.astype(np.uint32)
            names, cuts = np.unique(span, return_index=True)
            blobs, more = [], []
            for prints, times in zip(np.split(print32, cuts[1:]), np.split(beyond, cuts[1:])):
                blobs.append(prints.tobytes())
                more.append(np.column_stack([prints[times > 0], times[times > 0]]).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary()), pa.array(more, pa.binary())],
                                              ["range", "blob", "more"])
        for batch in batches:
            for h in arrays(batch):
                held.append(h)
                size += len(h)
                if size > FOLD:
                    yield flushed()
                    size = 0
        if size:
            yield flushed()
    return run


def _range_bits(total: int, most: int) -> int:
    """Ranges of about two million occurrences each: a task's share doesn't follow the corpus."""
    return min(max(6, math.ceil(math.log2(max(1, total) / (1 << 21)))), most)


def _counted(rows) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a range, and how often each was met."""
    prints, times = np.unique(np.concatenate([np.frombuffer(b, np.uint32) for b in rows["blob"]]), return_counts=True)
    more = np.concatenate([np.frombuffer(b, np.uint32).reshape(-1, 2) for b in rows["more"]])
    np.add.at(times, np.searchsorted(prints, more[:, 0]), more[:, 1].astype(np.int64))
    return prints, times


def _by_range(rows: DataFrame, bits: int, hashes, table) -> tuple[DataFrame, str]:
    """(range, blob): ``table(prints, times)`` of each range, packed; and where it is stored."""
    def packed(key, rows):
        return rows.iloc[:1][["range"]].assign(blob=[zlib.compress(table(*_counted(rows)).tobytes(), 1)])
    met = rows.mapInArrow(_fingerprints(bits, hashes), "range long, blob binary, more binary")
    return passing(met.groupBy("range").applyInPandas(packed, "range long, blob binary"), "jaccard-levels")


def frequency_levels(docs: DataFrame, slot_bits: int = SLOT_BITS) -> bytes:
    """Per slot (the top bits of a hash) the log2 of the largest frequency in it, 15 at most, 0 if all occur once;
    two slots a byte. Two slots a shingle, by the texts' bytes, up to ``2**slot_bits``."""
    total = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    slot_bits = min(slot_bits, max(16, math.ceil(math.log2(total + 1)) + 1))
    bits = _range_bits(total, slot_bits - 4)

    def levels(prints, times):
        many = times > 1
        table = np.zeros(1 << (slot_bits - bits), np.uint8)
        np.maximum.at(table, prints[many] >> np.uint32(32 - slot_bits + bits), np.log2(times[many]).astype(np.uint8))
        return table

    got, at = _by_range(docs.select("text"), bits, _shingles, levels)
    out = np.zeros((1 << bits, 1 << (slot_bits - bits - 1)), np.uint8)
    for r in got.toLocalIterator():      # 2**(slot_bits - 1) bytes in all, a file split at a time
        level = np.minimum(np.frombuffer(zlib.decompress(r["blob"]), np.uint8), 15)
        out[r["range"]] = level[::2] | level[1::2] << 4
    remove(docs.sparkSession, at)
    return out.tobytes()


class Marks(NamedTuple):
    """Two bits are set for every hash that was met often enough; others may have theirs by chance."""
    bits: int             # of a hash that name its range
    width: int            # the logarithm of a range's bits
    shared: object        # a broadcast of all ranges' bits

    def of(self, hashes: np.ndarray) -> np.ndarray:
        table = np.frombuffer(self.shared.value, np.uint8)
        start = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) << self.width
        met = np.ones(len(hashes), bool)
        for place in _two_places((hashes >> np.uint64(32 - self.bits)).astype(np.uint32), self.width):
            bit = start + place
            met &= (table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)
        return met


def _two_places(prints: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple((x >> np.uint32(32 - width)).astype(np.int64) for x in (prints, prints * np.uint32(0x9E3779B1)))


def marks(values: DataFrame, least: int, mark_bits: int = MARK_BITS) -> Marks:
    """Of the hashes (one column of longs, or of lists of them) that occur ``least`` times or more. Eight bits a hash, up to ``2**mark_bits``."""
    spark, column = values.sparkSession, values.columns[0]
    size = F.size(column) if values.schema[0].dataType.typeName() == "array" else F.lit(1)
    total = values.filter(F.col(column).isNotNull()).agg(F.sum(size.cast("long"))).first()[0] or 0
    mark_bits = min(mark_bits, max(16, math.ceil(math.log2(total + 1)) + 3))
    bits = _range_bits(total, mark_bits - 4)
    width = mark_bits - bits

    def marked(prints, times):
        table = np.zeros(1 << width, np.uint8)
        for place in _two_places(prints[times >= least], width):
            table[place] = 1
        return np.packbits(table)

    got, at = _by_range(values, bits, _numbers, marked)
    out = np.zeros((1 << bits, 1 << (width - 3)), np.uint8)
    for r in got.toLocalIterator():
        out[r["range"]] = np.frombuffer(zlib.decompress(r["blob"]), np.uint8)
    remove(spark, at)
    return Marks(bits, width, spark.sparkContext.broadcast(out.tobytes()))


def levels_of(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The level of each hash's slot in a table of two slots a byte."""
    slot = (hashes >> np.uint64(64 - len(table).bit_length())).astype(np.int64)
    return table[slot >> 1] >> (4 * (slot & 1)).astype(np.uint8) & 15


class Signature(NamedTuple):
    asked: int            # matches asked for
    matched: int          # shingles that occur more than once
    mean_level: float     # how frequent the shingles are
    tokens: np.ndarray    # shingles of the prefix that occur more than once, rare ones first
    places: np.ndarray    # and their places in the order, from 0


def prefix(hashes: np.ndarray, levels: np.ndarray) -> Signature:
    """The prefix that costs least."""
    level = levels_of(hashes, levels)
    order = np.lexsort((hashes, level))
    cost = np.cumsum(np.where(level[order] > 0, 2.0 ** level[order], 0.0))
    n = len(hashes)
    least = n - -(-NUM * n // DEN)
    choices = [m for m in MATCHES if least + m <= n and m <= n - least]
    # Reading a prefix's groups, and verifying the share of what they bring that has enough matches.
    best = min(choices, key=lambda m: (cost[least + m - 1] * (1 + 8 / m), m))
    first = order[:least + best]
    places = np.flatnonzero(level[first] > 0)
    return Signature(best, int((level > 0).sum()), float(level.mean()), hashes[first[places]], places)


SIGNED = "n long, key binary, digest long, asked int, matched long, mean_level double, tokens array<long>, places array<int>"


def _digest(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _prefixes(shared):
    def run(batches):
        # The table is the broadcast's own bytes: no copy of it in a worker.
        make, levels = Shingler(), np.frombuffer(shared.value, np.uint8)
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for t in part.column(1).cast(pa.binary()).to_pylist():
                    h = make(t)
                    if not len(h):
                        out.append((0, *[None] * 7))
                        continue
                    got = prefix(h, levels)
                    out.append((len(h), xxhash.xxh3_128_digest(h.tobytes()), _digest(t), got.asked, got.matched, got.mean_level,
                                *((got.tokens.view(np.int64), got.places) if len(got.tokens) else (None, None))))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]],
                                                 ["id", "n", "key", "digest", "asked", "matched", "mean_level", "tokens", "places"])
    return run


def _marked_only(marked: Marks):
    """Rows with those of their tokens that are marked, and the places of these; nulls where none is."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                tokens, places = part.column("tokens"), part.column("places")
                flat = tokens.flatten()
                keep = marked.of(flat.to_numpy(zero_copy_only=False).view(np.uint64))
                row = np.repeat(np.arange(part.num_rows), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                left = np.bincount(row[keep], minlength=part.num_rows)
                ends = pa.array(np.r_[0, np.cumsum(left)], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x.filter(pa.array(keep)), mask=pa.array(left == 0)) for x in (flat, places.flatten())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in part.schema.names[:-2]], *lists], part.schema.names)
    return run


def shared_only(signed: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``signed`` (the last two columns: tokens, places) without tokens that no other row has; and where it is stored."""
    met = marks(signed.select("tokens"), 2)
    out = passing(signed.mapInArrow(_marked_only(met), signed.schema), name)
    met.shared.destroy()
    return out


def _again(marked: Marks):
    """(key, hashes) of the texts whose digests are marked, each text once a task."""
    def run(batches):
        make, seen = Shingler(), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                texts = [t for t in batch.column(0)[at:at + 64].cast(pa.binary()).to_pylist() if t]
                digests, out = [_digest(t) for t in texts], []
                for t, d, met in zip(texts, digests, marked.of(np.array(digests, np.int64).view(np.uint64))):
                    if met and d not in seen:
                        seen.add(d)
                        h = make(t).tobytes()
                        out.append((xxhash.xxh3_128_digest(h), h))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], ["key", "hashes"])
    return run


def hashes_of(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> tuple[DataFrame, str]:
    """(key, hashes) of the sets in the pairs (a, b), made from their texts; and where it is stored."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted, at = passing(sets.select("key", "digest").join(keys, "key", "left_semi"), "jaccard-wanted")
    met = marks(wanted.select("digest"), 1)
    rows = docs.select("text").mapInArrow(_again(met), "key binary, hashes binary")
    out = passing(rows.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "jaccard-hashes")
    met.shared.destroy()
    remove(docs.sparkSession, at)
    return out


def _verified(batches):
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            inter = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(DEN * inter >= NUM * (len(a) + len(b) - inter))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(parts: list[DataFrame], sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys that reach the similarity. ``parts`` of them are made one after the other."""
    pairs_at = shared_dir(docs.sparkSession, "jaccard-pairs")
    for part in parts:
        part.select("a", "b").write.mode("append").parquet(pairs_at)
    pairs = docs.sparkSession.read.schema("a binary, b binary").parquet(pairs_at)
    if pairs.isEmpty():
        return pairs
    hashes, hashes_at = hashes_of(pairs, sets, docs)
    rows = pairs.join(hashes.select(F.col("key").alias("a"), F.col("hashes").alias("x")), "a")
    rows = rows.join(hashes.select(F.col("key").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")
    out = save(rows.mapInArrow(_verified, "a binary, b binary"), "jaccard-links")
    remove(docs.sparkSession, pairs_at, hashes_at)
    return out


def _up(n: str, num: int, den: int) -> str:
    """SQL of ``n * num / den``, rounded up."""
    return f"(({n}) * {num} + {den - 1}) div {den}"


def _needed(x: str, y: str) -> str:
    """SQL of the least intersection of two sets of these sizes that reach the similarity."""
    return _up(f"{x} + {y}", NUM, NUM + DEN)


def _may_reach(x: str, y: str):
    """Whether sets (columns n and matched under these names) can reach the similarity."""
    n, matched = (x.format("n"), y.format("n")), (x.format("matched"), y.format("matched"))
    return F.expr(f"least({matched[0]}, {matched[1]}) >= {_needed(*n)}")


def _open_groups(members: DataFrame, turn: int) -> DataFrame:
    """(token, leader) of the shingles whose sets have different labels; after the first turn a leader is drawn by hash."""
    rank = F.col("mean_level") if turn == 0 else F.xxhash64("key", F.lit(turn)).cast("double")
    drawn = F.struct(rank.alias("rank"), "label", "key", "n", "matched", "asked")
    groups = members.groupBy("token").agg(F.max(drawn).alias("leader"), F.min("label").alias("first"), F.max("label").alias("last"))
    return groups.filter("first <> last").select("token", "leader")


def _open_sets(index: DataFrame, labels: DataFrame) -> tuple[DataFrame, str]:
    """The sets that may still link to one of another label, with the tokens (and places, in order) they share with such sets;
    and where they are stored.

    Sets that reach the similarity share as many of these as the smaller of the two asks for, so a set that has
    fewer goes. Then others have fewer, so there is a second look."""
    rows, before = index.join(labels, "key"), None
    for _ in range(2):
        groups = rows.groupBy("token").agg(F.min("asked").alias("low"), F.min("label").alias("first"), F.max("label").alias("last"))
        met = rows.join(groups.filter("first <> last").select("token", "low"), "token")
        sets = met.groupBy("key", "label", "n", "matched", "asked").agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("at"), F.min("low").alias("low"))
        sets = sets.filter("size(at) >= least(asked, low)").select(
            "key", "label", "n", "matched", "asked", F.col("at.token").alias("tokens"), F.col("at.place").alias("places"))
        sets, path = passing(sets, "jaccard-open")
        if before:
            remove(index.sparkSession, before)
        rows = sets.select("key", "label", "n", "matched", "asked", F.explode(F.arrays_zip("tokens", "places")).alias("at")).select(
            "key", "label", "n", "matched", "asked", F.col("at.tokens").alias("token"), F.col("at.places").alias("place"))
        before = path
    return sets, path


def _slices(sets: DataFrame, room: int) -> int:
    """In how many parts ``_across_labels`` is run so that one moves about ``room`` bytes: a row for each shingle holds all of its set."""
    return 1 + (sets.agg(F.sum(16 * F.size("tokens").cast("long") * F.size("tokens"))).first()[0] or 0) // max(room, 1 << 25)


def _across_labels(sets: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """Pairs (a, b) of sets (those of ``_open_sets``) with different labels that the bounds leave, a the larger.

    Sets meet in the group of the first shingle that their prefixes share, where all shared ones are counted, so a pair
    is made once, not once a shared shingle. A part of the shingles makes the pairs that meet there."""
    names = ("key", "n", "matched", "asked", "label")
    behind_a, behind_b = f"{_up('n_a', NUM, DEN)} - asked_a", f"{_up('n_b', 2 * NUM, NUM + DEN)} - asked_b"   # shingles after the prefix
    large, small = (sets.select(*[F.col(c).alias(f"{c}_{s}") for c in names], "tokens", "places") for s in "ab")
    in_part = f"token_at -> pmod(token_at.tokens, {parts}) = {part}"
    # As the smaller one a set is read up to a shorter prefix.
    first = F.expr(f"size(filter(places, p -> p < n_b - ({behind_b})))")
    small = small.withColumn("tokens", F.slice("tokens", 1, first)).withColumn("places", F.slice("places", 1, first))
    large, small = (x.withColumn(f"tokens_{s}", F.col("tokens")).withColumn("at", F.explode(F.expr(f"filter(arrays_zip(tokens, places), {in_part})"))).select(
        F.col("at.tokens").alias("token"), F.col("at.places").alias(f"place_{s}"), f"tokens_{s}", *[f"{c}_{s}" for c in names])
        for x, s in ((large, "a"), (small, "b")))
    needed, shared = _needed("n_a", "n_b"), "array_intersect(tokens_a, tokens_b)"     # in the order of the prefixes
    met = large.join(small, "token").filter(
        F.expr("(n_a > n_b or n_a = n_b and key_a > key_b) and label_a <> label_b")).filter(_may_reach("{}_a", "{}_b")).filter(
        F.expr(f"least(place_a, place_b) + least(n_a - place_a, n_b - place_b) >= {needed}")).filter(
        F.expr(f"exists(array({shared}), x -> x[0] = token and size(x) >= {needed} - greatest({behind_a}, {behind_b}))"))
    return met.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def _led(members: DataFrame, sets: DataFrame, docs: DataFrame, turn: int) -> DataFrame:
    """Links (a, b) found by comparing each set (b) with the leader (a) it shares most shingles with."""
    met = members.join(_open_groups(members, turn), "token").filter(F.col("label") != F.col("leader.label")).filter(_may_reach("{}", "leader.{}"))
    # What they share lies in both prefixes, or behind the one that ends first.
    behind = [f"{_up(n, NUM, DEN)} - {asked}" for n, asked in (("n", "asked"), ("leader.n", "leader.asked"))]
    lacking = F.expr(f"{_needed('n', 'leader.n')} - greatest({', '.join(behind)})")
    met = met.groupBy(F.col("leader.key").alias("a"), F.col("key").alias("b")).agg(F.count(F.lit(1)).alias("times"), F.first(lacking).alias("least"))
    pairs = met.filter("times >= least").groupBy("b").agg(F.max(F.struct("times", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    return verify([pairs], sets, docs)


def _under_leaders(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, label): the leader's leader. One link per b: cheaper than components, and sets of one label are linked too."""
    step = nodes.join(links.select(F.col("b").alias("key"), "a"), "key", "left").select("key", F.coalesce("a", "key").alias("label"))
    above = step.select(F.col("key").alias("label"), F.col("label").alias("above"))
    return step.join(above, "label").select("key", F.col("above").alias("label"))


def link_classes(sets: DataFrame, docs: DataFrame, room: int) -> DataFrame:
    """``sets``: the columns of SIGNED, distinct keys. (key, label) of their components.
    ``room``: bytes that a step may move at a time."""
    index = sets.select(F.explode(F.arrays_zip("tokens", "places")).alias("at"), "key", "n", "matched", "asked", "mean_level")
    index, at = passing(index.select(F.col("at.tokens").alias("token"), F.col("at.places").alias("place"), "key", "n", "matched", "asked", "mean_level"), "jaccard-index")
    nodes = sets.select("key")
    # The leaders only save pairs below: what is still open after them is compared in full.
    links = _led(index.withColumn("label", F.col("key")), sets, docs, 0)
    labels = save(_under_leaders(nodes, links), "jaccard-labels")
    found = _led(index.join(labels, "key"), sets, docs, 1)
    links = links.unionByName(found)
    labels = save(connect(nodes, links), "jaccard-labels")
    left, left_at = _open_sets(index, labels)
    parts = _slices(left, room)
    found = verify([_across_labels(left, k, parts) for k in range(parts)], sets, docs)
    remove(docs.sparkSession, at, left_at)
    if found.isEmpty():
        return labels
    return save(connect(nodes, links.unionByName(found)), "jaccard-labels")


def components(docs: DataFrame, id_col: str = "doc_id", slot_bits: int = SLOT_BITS) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest identifier that links reach)."""
    with shuffles_freed(docs.sparkSession):
        return _components(docs.select(F.col(id_col).alias("id"), "text"), slot_bits)


def _components(rows: DataFrame, slot_bits: int) -> DataFrame:
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(frequency_levels(rows, slot_bits))
    whole, whole_at = passing(rows.mapInArrow(_prefixes(shared), f"id {kind}, {SIGNED}"), "jaccard-signed")
    shared.destroy()
    signed, _ = shared_only(whole, "jaccard-signed")
    remove(spark, whole_at)
    classes = save(signed.filter("n > 0").groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")), "jaccard-classes")
    found = signed.filter("tokens is not null")
    same = (found["key"] == classes["key"]) & found["id"].eqNullSafe(classes["least"])
    # Of the rows of a class, which share all their shingles, one is left, so the shingles of classes that are alone go now.
    once, once_at = passing(found.join(classes, same, "left_semi").dropDuplicates(["key"]).drop("id"), "jaccard-sets")
    sets, sets_at = shared_only(once, "jaccard-sets")
    remove(spark, once_at)
    signed = signed.select("id", F.col("n").alias("n_shingles"), "key")
    # As much at a time as all hashes would take.
    room = 8 * (signed.agg(F.sum("n_shingles")).first()[0] or 0)
    labels = link_classes(sets.filter("tokens is not null"), rows, room)
    remove(spark, sets_at)
    least = labels.join(classes, "key").groupBy("label").agg(F.min("least").alias("component_id"))
    linked = labels.join(least, "label").select("key", "component_id")
    # A class of one row that links to nothing is its own component: no need to join it.
    groups = classes.join(linked, "key", "left").withColumn("component_id", F.coalesce("component_id", "least"))
    groups = save(groups.filter((F.col("copies") > 1) | ~F.col("component_id").eqNullSafe(F.col("least"))).select("key", "component_id"), "jaccard-components")
    some = signed.filter("n_shingles > 0").join(groups, "key", "left").select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    return some.unionByName(signed.filter("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id")))


def drop_near(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one text of every component, the one with the smallest identifier, all columns kept.

    A text is known by identifier and digest: a null identifier, or one that stands on several texts,
    takes no other text along."""
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256)
    # Null identifiers last; equal identifiers in order of the digest.
    text_id = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), digest.alias("digest"))
    found = save(components(docs.select(text_id.alias("text_id"), "text"), "text_id").filter("n_shingles > 0").select(
        "id.id", "id.digest", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")), "jaccard-found")
    gone = found.filter(~F.col("kept")).select("id", "digest").distinct()
    again = save(found.filter("kept").groupBy("id", "digest").count().filter("count > 1").select("id", "digest"), "jaccard-again")
    left = docs.join(gone, docs[id_col].eqNullSafe(gone["id"]) & (digest == gone["digest"]), "left_anti")
    if again.isEmpty():
        return left
    same = docs[id_col].eqNullSafe(again["id"]) & (digest == again["digest"])
    return left.join(again, same, "left_anti").unionByName(
        left.join(again, same, "left_semi").dropDuplicates([id_col, "text"]))
