"""N-gram Jaccard join with several global token orders.

The set of a text is its distinct n-word shingles (hashed to 64 bits). Two
sets of similarity t or more share a token among the first
``m - ceil(t m) + 1`` tokens of each, whatever global order sorts the tokens,
so a candidate must do so under every one of three orders:

* order 1 puts tokens with a small hash first, and those by the number of
  sets that have them, so passages that many texts share come last. A set
  whose first tokens are its own alone has no partner and is dropped here;
* orders 2 and 3 sort by two other hashes. A pair found under order 1 is
  verified only if its prefixes meet under both of them.

Copies are folded first: texts of one set are one class. Texts that meet at a
token are compared with a few pivots of that token; what the links found so far
connect need not be compared again, and only pairs across components remain.
Tokens with the same sets are one list. The pairs of short lists are compared
as they are, each once. A long list is dealt out as pairs of blocks, each block
with its texts: a task counts the tokens that two sets have in common among
their first ones under orders 2 and 3, drops the pairs that already miss more
there than similar sets may, compares the rest, and returns a few links that
connect the same texts, never the pairs. So a group of n near copies costs
about n comparisons, and no link that joins two groups is lost.

Nulls: a null or empty text has no shingle and is linked with nothing; so is
one without words. A null id never names a component unless alone. Repeated
rows fall into one class. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlens.llm.arrays import FACTORS, mix, shingle_sets
from memberlens.llm.common import checkpointed, components, partitions, pieces, runs, slim


PIVOTS = 5
TILE = 1000
#: Longer lists of sets that have a token are dealt out in blocks of at most so many sets and tokens.
SHORT = 32
BLOCK = 2048
BLOCK_TOKENS = 1 << 21
COLUMNS = 4096


def prefix_size(m, percent: int):
    """Tokens among which a set of ``m`` shares one with every similar set."""
    return m - (percent * m + 99) // 100 + 1


def region(percent: int) -> np.uint64:
    """Hashes below this are sorted by their frequency: several times what a prefix holds."""
    return np.uint64(min(1.0, max(0.5, (100 - percent) / 60)) * (2**64 - 2**12))


def set_keys(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens ^ FACTORS[20]))])
    size = np.diff(at).astype(np.uint64)
    return mix((sums[at[1:]] - sums[at[:-1]]) * FACTORS[21] + size).view(np.int64)


def _described(n: int, percent: int):
    """Per text: its set's size, digest, number of tokens in the region, and the tokens that fill a longer prefix."""
    limit = region(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t"):
            tokens, at = shingle_sets(batch.column("t"), n)
            m = np.diff(at)
            low = np.add.reduceat(np.concatenate([tokens < limit, [False]]).astype(np.int64), at[:-1]) * (m > 0)
            extra = np.maximum(np.where(m > 0, prefix_size(m, percent), 0) - low, 0)
            first = at[:-1] + low
            yield pa.RecordBatch.from_arrays([
                batch.column("i"), pa.array(m), pa.array(set_keys(tokens, at)), pa.array(low),
                pa.array([tokens[a:a + k].view(np.int64) for a, k in zip(first, extra)], pa.list_(pa.int64()))],
                ["id", "m", "key", "low", "extra"])
    return run


def _dealt(n: int, percent: int, buckets: int):
    """The tokens of the region, dealt to buckets: one row for each piece of texts and bucket."""
    limit = region(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t", 2 << 20):
            tokens, at = shingle_sets(batch.column("t"), n)
            key = np.repeat(set_keys(tokens, at), np.diff(at))
            low = tokens < limit
            tokens, key = tokens[low], key[low]
            if not len(tokens):
                continue
            bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((tokens, key, bucket))
            tokens, key, bucket = tokens[order], key[order], bucket[order]
            fresh = np.ones(len(tokens), bool)  # copies in one piece are sent once
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (key[1:] != key[:-1])
            tokens, key, bucket = tokens[fresh], key[fresh], bucket[fresh]
            head = np.ones(len(tokens), bool)
            head[1:] = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
            heads = np.flatnonzero(head)
            count = np.diff(np.concatenate([heads, [len(tokens)]])).astype(np.uint32)
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            at_head = np.searchsorted(heads, cut)
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[cut[:-1]]),
                pa.array([key[heads[a:b]].tobytes() for a, b in zip(at_head, at_head[1:])], pa.binary()),
                pa.array([count[a:b].tobytes() for a, b in zip(at_head, at_head[1:])], pa.binary()),
                pa.array([tokens[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                ["bucket", "keys", "counts", "tokens"])
    return run


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where rows that differ from the one before begin, and the end."""
    n = len(columns[0])
    new = np.zeros(n + 1, bool)
    new[[0, n]] = True
    for c in columns:
        new[1:n] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _joined(group: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(column).to_pylist()), kind)


def _shared(ranges: int):
    """Of each bucket, the tokens that several sets have, with the number of those sets: a row for each range of sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "bucket"):
            tokens = _joined(group, "tokens", np.uint64)
            key = np.repeat(_joined(group, "keys", np.int64), _joined(group, "counts", np.uint32))
            order = np.lexsort((key, tokens))
            tokens, key = tokens[order], key[order]
            first = _cuts(tokens, key)[:-1]
            tokens, key = tokens[first], key[first]
            head = _cuts(tokens)
            df = np.repeat(np.diff(head), np.diff(head))
            several = df > 1
            tokens, key, df = tokens[several], key[several], df[several]
            if not len(key):
                continue
            part = (mix(key.view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
            order = np.lexsort((key, part))
            tokens, key, df, part = tokens[order], key[order], df[order].astype(np.uint32), part[order]
            cut, sets = _cuts(part), _cuts(part, key)
            count = np.diff(sets).astype(np.uint32)
            to = np.searchsorted(sets, cut)
            blobs = lambda x, at: pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cut[:-1]]), blobs(key[sets[:-1]], to), blobs(count, to), blobs(tokens, cut), blobs(df, cut)],
                ["part", "keys", "counts", "tokens", "dfs"])
    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each set of a range: its tokens that others have too, and in how many sets each is."""
    for group in runs(batches, "part"):
        key = np.repeat(_joined(group, "keys", np.int64), _joined(group, "counts", np.uint32))
        tokens, df = _joined(group, "tokens", np.int64), _joined(group, "dfs", np.uint32).astype(np.int64)
        order = np.argsort(key, kind="stable")
        key, tokens, df = key[order], tokens[order], df[order]
        cut = _cuts(key)
        for a in range(0, len(cut) - 1, 2000):
            part = cut[a:a + 2001]
            lists = lambda x: pa.ListArray.from_arrays(
                pa.array(part - part[0], pa.int32()), pa.array(x[part[0]:part[-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(key[part[:-1]]), lists(tokens), lists(df)], ["key", "tokens", "dfs"])


def _prefixes(percent: int):
    """The prefix under order 1, without the tokens that no other set has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, alone = [], []
            for m, low, extra, tokens, dfs in zip(*(batch.column(c).to_pylist()
                                                    for c in ("m", "low", "extra", "tokens", "dfs"))):
                tokens, df = np.array(tokens or [], np.int64), np.array(dfs or [], np.int64)
                room = prefix_size(m, percent) - (low - len(tokens))
                first = tokens[np.lexsort((tokens.view(np.uint64), df))][:max(room, 0)].tolist()
                out.append(first + (extra or [])[:max(room - len(first), 0)])
                alone.append(low - len(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("m"), pa.array(alone, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                ["key", "m", "alone", "prefix"])
    return run


def _packed(n: int):
    """A text of each set, by the set's digest; what one task sees again is not sent again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        sent: set[int] = set()
        for batch in pieces(batches, "t"):
            tokens, at = shingle_sets(batch.column("t"), n)
            keys = set_keys(tokens, at).tolist()
            first = {k: j for j, k in reversed(list(enumerate(keys))) if k not in sent and at[j + 1] > at[j]}
            sent.update(first)
            z = [pack.compress(t.encode()) for t in batch.column("t").take(pa.array(list(first.values()), pa.int64())).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int64()), pa.array(z, pa.binary())], ["key", "z"])
    return run


def _texts(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(z).decode() for z in column.to_pylist()], pa.large_string())


def _size(z: bytes) -> int:
    return zstandard.frame_content_size(z)


def _cut(column: list[int], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to ``limit`` at most (one row at least)."""
    start, total = 0, 0
    for k, n in enumerate(column):
        if k > start and total + n > limit:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(column):
        yield start, len(column)


def _common(tokens: np.ndarray, start: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each pair of sets (x, y) the number of tokens in both."""
    both = np.concatenate([x, y])
    pair = np.repeat(np.concatenate([np.arange(len(x))] * 2), size[both])
    end = np.cumsum(size[both])
    token = tokens[np.arange(end[-1] if len(end) else 0) + np.repeat(start[both] - end + size[both], size[both])]
    order = np.lexsort((token, pair))
    token, pair = token[order], pair[order]
    return np.bincount(pair[1:][(token[1:] == token[:-1]) & (pair[1:] == pair[:-1])], minlength=len(x))


def _verified(n: int, percent: int):
    """The similar pairs of a tile, whose texts come first: filters of orders 2 and 3, then the sets themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, "tile"):
            text = pc.is_null(tile.column("b"))
            texts, pairs = tile.filter(text).combine_chunks(), tile.filter(pc.invert(text))
            packed = texts.column("z").combine_chunks()
            made = [shingle_sets(_texts(packed.slice(a, b - a)), n) for a, b in _cut([_size(z) for z in packed.to_pylist()])]
            tokens = np.concatenate([t for t, _ in made])
            size = np.concatenate([np.diff(at) for _, at in made])
            start = np.cumsum(size) - size
            doc = np.repeat(np.arange(len(size)), size)
            key = texts.column("key").to_numpy()
            by_key = np.argsort(key)
            find = lambda c: by_key[np.searchsorted(key, pairs.column(c).to_numpy(), sorter=by_key)]
            x, y = find("key"), find("b")
            shorter = np.where(size > 0, prefix_size(size, percent), 0)
            prefixes = []
            for factor in (FACTORS[22], FACTORS[23]):
                other = mix(tokens * factor)
                prefixes.append(other[np.lexsort((other, doc))])
            for a, b in _cut((size[x] + size[y]).tolist(), 1 << 20):
                p, q = x[a:b], y[a:b]
                for other in prefixes:
                    meet = _common(other, start, shorter, p, q) > 0
                    p, q = p[meet], q[meet]
                both = _common(tokens, start, size, p, q)
                good = 100 * both >= percent * (size[p] + size[q] - both)
                yield pa.RecordBatch.from_arrays([pa.array(key[p[good]]), pa.array(key[q[good]])], ["a", "b"])
    return run


def _few(percent: int):
    """The pairs of short lists that could be similar and are not yet connected, each once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in [*batches, None]:
            parts = [t for t in (held, None if batch is None else pa.Table.from_batches([batch])) if t is not None]
            if not parts:
                return
            rows = pa.concat_tables(parts).combine_chunks()
            token, key, m, alone, root = (rows.column(c).to_numpy() for c in ("token", "key", "m", "alone", "root"))
            # The last list goes on in the next batch.
            whole = len(token) if batch is None else int(np.searchsorted(token, token[-1])) if len(token) else 0
            held = rows.slice(whole)
            found = []
            for d in range(1, min(SHORT, whole)):
                x = np.flatnonzero((token[:whole - d] == token[d:whole]) & (root[:whole - d] != root[d:whole]))
                y = x + d
                good = _close(m[x], m[y], m[x] - alone[x], m[y] - alone[y], percent)
                found.append(np.column_stack([np.minimum(key[x], key[y]), np.maximum(key[x], key[y])])[good])
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    return run


def _required(ma, mb, percent: int):
    """Tokens that similar sets of these sizes have in common at least."""
    return -(-percent * (ma + mb) // (100 + percent))


def _close(ma, mb, ca, cb, percent: int):
    """Whether sets of these sizes can be similar if at most ``ca`` and ``cb`` of their tokens are common."""
    return ((np.minimum(ma, mb) * 100 >= np.maximum(ma, mb) * percent)
            & (np.minimum(ca, cb) >= _required(ma, mb, percent)))


def _matrix(tokens: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray):
    """For each pair of a left and a right set the number of these tokens in both, by products of 0-1 matrices."""
    count = np.zeros((len(left), len(right)), np.float32)
    names, column = np.unique(tokens, return_inverse=True)
    place = np.full(int(max(left.max(), right.max())) + 1, -1)
    sides = []
    for side in (left, right):
        place[:] = -1
        place[side] = np.arange(len(side))
        at = place[doc]
        sides.append((at[at >= 0], column[at >= 0]))
    both = np.bincount(sides[0][1], minlength=len(names)) * np.bincount(sides[1][1], minlength=len(names)) > 0
    if left is right:
        both = np.bincount(sides[0][1], minlength=len(names)) > 1
    number = np.cumsum(both) - 1
    sides = [(at[both[c]], number[c[both[c]]]) for at, c in sides]
    for start in range(0, int(both.sum()), COLUMNS):
        dense = []
        for (at, c), side in zip(sides, (left, right)):
            here = (c >= start) & (c < start + COLUMNS)
            one = np.zeros((len(side), COLUMNS), np.float32)
            one[at[here], c[here] - start] = 1
            dense.append(one)
            if left is right:
                dense.append(one)
                break
        count += dense[0] @ dense[1].T
    return count


def _block_links(n: int, percent: int):
    """Links that connect what a pair of blocks connects: filters of orders 2 and 3, counted, then the sets themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for deal in runs(batches, "deal"):
            z = deal.column("z").combine_chunks()
            made = [shingle_sets(_texts(z.slice(a, b - a)), n) for a, b in _cut([_size(x) for x in z.to_pylist()])]
            tokens = np.concatenate([t for t, _ in made])
            size = np.concatenate([np.diff(at) for _, at in made])
            start = np.cumsum(size) - size
            doc = np.repeat(np.arange(len(size)), size)
            key, mine = deal.column("key").to_numpy(), deal.column("mine").to_numpy()
            root = np.unique(deal.column("root").to_numpy(), return_inverse=True)[1].astype(np.int64)
            b1, b2 = int(deal.column("b1")[0].as_py()), int(deal.column("b2")[0].as_py())
            left = np.flatnonzero(mine == b1)
            right = left if b1 == b2 else np.flatnonzero(mine == b2)
            if not len(left) or not len(right):
                continue
            sizes = size[left][:, None], size[right][None, :]
            need = _required(*sizes, percent)
            alive = (_close(*sizes, *sizes, percent) & (root[left][:, None] != root[right][None, :])
                     & (left[:, None] < right[None, :] if left is right else True))
            exact = False
            for factor, share in ((22, 0.02), (23, 0.02), (None, 0.01)):
                # Of the tokens below the bar, similar sets miss no more of each other than of all tokens.
                if alive.sum() <= 4 * len(left):
                    break
                bar = np.uint64(min(1.0, share * (100 - percent)) * (2**64 - 2**12))
                low = np.ones(len(tokens), bool) if factor is None else mix(tokens * FACTORS[factor]) < bar
                common = _matrix(tokens[low], doc[low], left, right)
                own = np.bincount(doc[low], minlength=len(size))
                alive &= ((own[left][:, None] - common <= sizes[0] - need) & (own[right][None, :] - common <= sizes[1] - need))
                exact = factor is None
            found = []
            while True:
                p = np.flatnonzero(alive.any(axis=1))
                if not len(p):
                    break
                q = alive[p].argmax(axis=1)
                alive[p, q] = False
                x, y = left[p], right[q]
                if not exact:
                    good = []
                    for a, b in _cut((size[x] + size[y]).tolist(), 1 << 20):
                        both = _common(tokens, start, size, x[a:b], y[a:b])
                        good.append(100 * both >= percent * (size[x[a:b]] + size[y[a:b]] - both))
                    good = np.concatenate(good)
                    x, y = x[good], y[good]
                if not len(x):
                    continue
                found += list(zip(key[x].tolist(), key[y].tolist()))
                root = _merged(root, x, y)
                alive &= root[left][:, None] != root[right][None, :]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], ["a", "b"])
    return run


def _merged(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The component of each set once those of each pair (x, y) are one."""
    name = np.arange(root.max() + 1)
    while True:
        a, b = name[root[x]], name[root[y]]
        if (a == b).all():
            return name[root]
        np.minimum.at(name, np.maximum(a, b), np.minimum(a, b))
        while (name[name] != name).any():
            name = name[name]


def _links(pairs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that pass the filters of orders 2 and 3 and are similar.

    Pairs are dealt to tiles of about ``TILE`` by a block of each side, and a
    tile gets each of its texts once: of m texts that are all to be compared,
    about m * m / sqrt(TILE) copies move, not m * m.
    """
    pairs = checkpointed(pairs)
    sides = max(1, math.ceil(math.sqrt(pairs.count() / TILE)))
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(TILE)), F.lit(sides))
    tiled = pairs.withColumn("tile", block("a") * sides + block("b"))
    wanted = tiled.select("tile", F.explode(F.array("a", "b")).alias("key")).distinct()
    texts = wanted.join(sets, "key").select("tile", "key", F.lit(None).cast("long").alias("b"), "z")
    rows = texts.unionByName(tiled.select("tile", F.col("a").alias("key"), "b", F.lit(None).cast("binary").alias("z")))
    return checkpointed(rows.repartition("tile").sortWithinPartitions("tile", F.col("b").asc_nulls_first())
                        .mapInArrow(slim(_verified(n, percent)), "a long, b long"))


def _placed(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``id, m, key, root`` of every row: the size and digest of its set, and its component, null without words."""
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    described = checkpointed(rows.mapInArrow(
        slim(_described(n, percent)), "id long, m long, key long, low long, extra array<long>"))
    classes = (described.where("m > 0").groupBy("key")
               .agg(F.any_value("m").alias("m"), F.any_value("low").alias("low"), F.any_value("extra").alias("extra")))
    many = partitions(docs)
    dealt = rows.mapInArrow(slim(_dealt(n, percent, many)), "bucket long, keys binary, counts binary, tokens binary")
    shared = (dealt.repartition(many, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(slim(_shared(many)), "part long, keys binary, counts binary, tokens binary, dfs binary")
              .repartition(many, "part").sortWithinPartitions("part")
              .mapInArrow(slim(_gathered), "key long, tokens array<long>, dfs array<long>"))
    own = F.col("low") - F.when(F.col("tokens").isNotNull(), F.size("tokens")).otherwise(F.lit(0))
    need = F.expr(f"m - (({percent} * m + 99) div 100) + 1")
    prefixes = checkpointed(
        classes.join(shared, "key", "left").where(own < need).select("key", "m", "low", "extra", "tokens", "dfs")
        .mapInArrow(slim(_prefixes(percent)), "key long, m long, alone long, prefix array<long>")
        .select("key", "m", "alone", F.explode("prefix").alias("token")))
    # The pivots of a token: the set with the fewest tokens of its own, the likeliest source of the others, and some
    # that a hash chooses, so that the sets of one group mostly have the same pivots.
    pivot = [F.min_by("key", F.struct("alone", "key")), *[F.min_by("key", F.xxhash64("key", F.lit(k))) for k in range(PIVOTS)]]
    pivots = (prefixes.groupBy("token").agg(F.min("key").alias("p"), F.max("key").alias("q"),
                                            F.array_distinct(F.array(*pivot)).alias("pivots"))
              .where("p <> q").select("token", "pivots"))
    met = checkpointed(prefixes.join(pivots, "token"))
    packed = rows.mapInArrow(slim(_packed(n)), "key long, z binary")
    sets = checkpointed(packed.join(met.select("key").distinct(), "key").dropDuplicates(["key"]))
    # A pair needs so many common tokens; those that a set has alone cannot be among them.
    common = F.ceil(F.lit(percent) * (F.col("ma") + F.col("mb")) / F.lit(100 + percent))
    close = ((F.least("ma", "mb") * 100 >= F.greatest("ma", "mb") * percent)
             & (F.col("ma") - F.col("ua") >= common) & (F.col("mb") - F.col("ub") >= common))
    sizes = met.select("key", "m", "alone").distinct()
    side = lambda c: sizes.select(F.col("key").alias(c), F.col("m").alias(f"m{c}"), F.col("alone").alias(f"u{c}"))
    star = (met.select("key", F.explode("pivots").alias("pivot")).where("key <> pivot")
            .select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct())
    star = checkpointed(star.join(side("a"), "a").join(side("b"), "b").where(close).select("a", "b"))
    links = _links(star, sets, n, percent)
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # What is left: pairs that meet at a token, across the components found so far; tokens of the same sets are one list.
    named = met.join(roots, met["key"] == roots["node"], "left").select(
        "token", "key", "m", "alone", F.coalesce("root", "key").alias("root"))
    lists = (named.groupBy("token").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("length"), F.sum("m").alias("tokens"),
        F.bit_xor(F.xxhash64("key")).alias("h"), F.sum(F.xxhash64("key", F.lit(1)).cast("decimal(38,0)")).alias("g"))
        .where("lo <> hi").groupBy("length", "tokens", "h", "g").agg(F.min("token").alias("token")))
    open_ = checkpointed(named.join(lists.select("token", "length", "tokens"), "token"))
    few = (open_.where(F.col("length") <= SHORT).repartition(many, "token").sortWithinPartitions("token")
           .mapInArrow(slim(_few(percent)), "a long, b long").distinct().join(star, ["a", "b"], "left_anti"))
    blocks = F.greatest(F.ceil(F.col("length") / BLOCK), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("long")
    placed = (open_.where(F.col("length") > SHORT).withColumn("blocks", blocks)
              .withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("key", "root", "mine", F.least("mine", "other").alias("b1"), F.greatest("mine", "other").alias("b2"),
                      F.xxhash64("token", F.least("mine", "other"), F.greatest("mine", "other")).alias("deal")))
    blocked = checkpointed(placed.join(sets, "key").repartition(many, "deal").sortWithinPartitions("deal")
                           .mapInArrow(slim(_block_links(n, percent)), "a long, b long"))
    more = _links(few, sets, n, percent).unionByName(blocked)
    roots = components(links.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v")))
    return described.join(roots, (described["key"] == roots["node"]) & (described["m"] > 0), "left").select(
        "id", "m", "key", F.when(F.col("m") > 0, F.coalesce("root", "key")).alias("root"))


def similar_texts(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: texts linked at a similarity of ``percent`` % or more."""
    placed = _placed(docs, n, percent, id_col, text_col)
    least = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    return (placed.join(least, "root", "left")
            .select(F.col("id").alias(id_col), F.col("m").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id")))


def _keyed(n: int, text: str):
    """The rows as they are, with the digest and size of the text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            tokens, at = shingle_sets(batch.column(text), n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(set_keys(tokens, at)), pa.array(np.diff(at))],
                                             [*batch.schema.names, "key", "m"])
    return run


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row of each group of linked texts, with the columns of ``docs``, and every row without words.

    The row with the smallest id stays, one with a null id only where all ids of
    the group are null. Groups are told apart by their sets, not by ids: a text
    that is alone stays, whatever other text has its id or has none. Of rows with
    one id and set, the one with the smallest columns stays, the text first.
    """
    inner = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    schema = ", ".join(f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in inner.items())
    keyed = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in inner.items()]).mapInArrow(
        slim(_keyed(n, inner[text_col])), f"{schema}, key long, m long")
    chosen = (_placed(docs, n, percent, id_col, text_col).where("root is not null").groupBy("root")
              .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("w"))
              .select(F.col("w.id").alias("w_id"), F.col("w.key").alias("w_key")))
    order = [inner[text_col], *[i for c, i in inner.items() if c != text_col]]
    ones = (keyed.where("m > 0").join(chosen, (F.col("key") == F.col("w_key"))
                                      & F.col(inner[id_col]).cast("long").eqNullSafe(F.col("w_id")))
            .groupBy("key").agg(F.min(F.struct(*order)).alias("row")).select(*[f"row.{i}" for i in inner.values()]))
    return (ones.unionByName(keyed.where("m = 0").select(*inner.values()))
            .select(*[F.col(i).alias(c) for c, i in inner.items()]))
