"""Suffix-array de-duplication: the common-prefix interval tree over contexts that documents share.

Every window of ``LEAST`` bytes is assigned to its anchor, the k-gram with
the smallest hash in it (the leftmost of equal ones). Equal windows have
equal anchors, so documents meet at anchors, of which there is about one for
sixteen bytes. The context of an anchor is what its windows can reach.

1. Anchors are dealt to buckets by hash, with a digest of their context. A
   context that a smaller document has as well is repeated whole. Where the
   contexts of an anchor differ, one of each kind goes on (its smallest
   document stands for it).
2. In each bucket an enhanced suffix array (suffixes of the contexts, sorted,
   with common-prefix lengths) is scanned with a stack. Every interval of a
   common prefix of ``LEAST`` bytes or more whose left extensions differ is a
   maximal repeat group; all its occurrences are reported, with the group's
   smallest document. A repeat longer than a context is a chain of groups
   that overlap; the spans of a document are their union.
3. Each document removes what it shares with a smaller one.

Texts are UTF-8 bytes; matches never cross documents, and strings are judged
on the input. Nulls: a null text is empty; a null id counts as larger than
any other. Rows with equal ids are one document to each other (nothing is
removed between them). Texts under ``LEAST`` bytes lose nothing. An empty
table gives an empty result; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberlens.llm.arrays import FACTORS, mix, powers, rolling, slice_hash, text_bytes
from memberlens.llm.common import partitions, pieces, runs, slim

GRAM = 20
PACKED = 5
#: A bucket of anchors is sorted in so many parts, each a suffix array of its own.
PARTS = 32
NO_ID = (1 << 63) - 1


def anchors(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Anchor positions, their texts, the ends of their contexts, and the 40-bit digests of anchor and context."""
    n, wide = len(data), least - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = rolling(data)
    count = n - GRAM + 1
    grams = mix((sums[GRAM:] - sums[:count]) * powers(count, True))
    place = np.uint64((1 << 28) - 1)
    least_of = (grams & ~place) | np.arange(count, dtype=np.uint64)
    size = 1
    while size * 2 <= wide:
        least_of = np.minimum(least_of[:-size], least_of[size:])
        size *= 2
    if size < wide:
        least_of = np.minimum(least_of[:len(least_of) - (wide - size)], least_of[wide - size:])
    long = np.diff(offsets) >= least
    inside = np.zeros(len(least_of) + 1, np.int64)
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - least + 1, -1)
    at = np.unique((least_of & place)[np.cumsum(inside[:-1]) > 0]).astype(np.int64)
    doc = np.searchsorted(offsets, at, "right") - 1
    start = np.maximum(offsets[doc], at - (least - GRAM))
    end = np.minimum(offsets[doc + 1], at + least)
    context = mix(slice_hash(sums, start, end) + (at - start).astype(np.uint64) * FACTORS[30])
    return at, doc, start, end, grams[at] >> np.uint64(24), context >> np.uint64(24)


def identity(gram: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One 64-bit name of an anchor with its context."""
    return mix(gram * FACTORS[31] + context * FACTORS[32])


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // PACKED, 8), np.uint8)
    out[:, :PACKED] = np.frombuffer(raw, np.uint8).reshape(-1, PACKED)
    return out.view("<u8").ravel()


def _dealt(least: int, buckets: int):
    """Digests of the anchors and contexts, dealt to buckets: a row for each piece of texts and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "t", 2 << 20):
            data, offsets = text_bytes(batch.column("t"))
            _, doc, _, _, gram, context = anchors(data, offsets, least)
            if not len(doc):
                continue
            ids, ranks = batch.column("r").to_numpy()[doc], batch.column("i").to_numpy()[doc]
            bucket = (mix(gram) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((context, gram, ids, bucket))
            bucket, ids, ranks, gram, context = (x[order] for x in (bucket, ids, ranks, gram, context))
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (context[1:] != context[:-1]) | (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1])
            bucket, ids, ranks, gram, context = (x[fresh] for x in (bucket, ids, ranks, gram, context))
            heads = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (bucket[1:] != bucket[:-1])]))
            count = np.diff(np.concatenate([heads, [len(ids)]])).astype(np.uint32)
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            to = np.searchsorted(heads, cut)
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[cut[:-1]]),
                pa.array([ids[heads[a:b]].tobytes() for a, b in zip(to, to[1:])], pa.binary()),
                pa.array([ranks[heads[a:b]].tobytes() for a, b in zip(to, to[1:])], pa.binary()),
                pa.array([count[a:b].tobytes() for a, b in zip(to, to[1:])], pa.binary()),
                pa.array([_pack(gram[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([_pack(context[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())],
                ["bucket", "ids", "ranks", "counts", "grams", "contexts"])
    return run


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By row: contexts that a smaller document has (whole), and those to compare with others of their anchor.

    Of a context, the rows of its smallest document are compared: one, unless rows share an id or have none.
    """
    for group in runs(batches, "bucket"):
        raw = {c: b"".join(group.column(c).to_pylist()) for c in ("ids", "ranks", "counts", "grams", "contexts")}
        count = np.frombuffer(raw["counts"], np.uint32)
        doc, rank = (np.repeat(np.frombuffer(raw[c], np.int64), count) for c in ("ids", "ranks"))
        gram, context = _unpack(raw["grams"]), _unpack(raw["contexts"])
        order = np.lexsort((doc, rank, context, gram))
        doc, rank, gram, context = doc[order], rank[order], gram[order], context[order]
        fresh = np.ones(len(doc), bool)  # copies of a row, from several pieces
        fresh[1:] = (doc[1:] != doc[:-1]) | (context[1:] != context[:-1]) | (gram[1:] != gram[:-1])
        doc, rank, gram, context = doc[fresh], rank[fresh], gram[fresh], context[fresh]
        new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
        new_kind = new_gram | np.concatenate([[True], context[1:] != context[:-1]])
        head = np.flatnonzero(new_kind)
        smallest = np.repeat(rank[head], np.diff(np.concatenate([head, [len(doc)]])))
        kinds = np.add.reduceat(new_kind.astype(np.int64), np.flatnonzero(new_gram))
        several = np.repeat(kinds > 1, np.diff(np.concatenate([np.flatnonzero(new_gram), [len(doc)]])))
        whole = rank > smallest
        compare = ~whole & several
        use = whole | compare
        name = identity(gram[use], context[use]).view(np.int64)
        doc, whole, bucket = doc[use], whole[use], (group.column("bucket")[0].as_py())
        order = np.lexsort((whole, doc))
        name, doc, whole = name[order], doc[order], whole[order]
        cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1]), [True]])) \
            if len(doc) else np.zeros(1, int)
        for a in range(0, len(cut) - 1, 5000):
            part = cut[a:a + 5001]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[part[:-1]]), pa.array(whole[part[:-1]]),
                pa.ListArray.from_arrays(pa.array(part - part[0], pa.int32()), pa.array(name[part[0]:part[-1]]))],
                ["doc", "whole", "names"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        k = batch.schema.get_field_index("t")
        z = pa.array([pack.compress(t.encode()) for t in batch.column(k).to_pylist()], pa.binary())
        yield batch.set_column(k, pa.field("z", pa.binary()), z)


def _unzipped(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of about ``limit`` bytes of text, and their texts as binary."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        texts, size, start = [], 0, 0
        for k, z in enumerate(batch.column("z").to_pylist()):
            texts.append(unpack.decompress(z))
            size += len(texts[-1])
            if size > limit or k + 1 == batch.num_rows:
                yield batch.slice(start, k + 1 - start), pa.array(texts, pa.large_binary())
                texts, size, start = [], 0, k + 1


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows and values of a list column; a null list has none."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).to_numpy()


def _tagged(row: np.ndarray, name: np.ndarray) -> np.ndarray:
    return mix(name.view(np.uint64) + (row.astype(np.uint64) + np.uint64(1)) * FACTORS[33])


def _contexts(least: int, buckets: int):
    """The bytes of the contexts to compare, with the bucket of their anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _unzipped(batches):
            data, offsets = text_bytes(texts)
            _, doc, start, end, gram, context = anchors(data, offsets, least)
            name = identity(gram, context).view(np.int64)
            use = np.isin(_tagged(doc, name), _tagged(*_flat(batch.column("compare"))))
            _, first = np.unique(_tagged(doc, name)[use], return_index=True)
            use = np.flatnonzero(use)[first]
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array((mix(gram[use]) % np.uint64(buckets * PARTS)).astype(np.int64)),
                batch.column("r").take(pa.array(doc[use])), batch.column("i").take(pa.array(doc[use])), pa.array(name[use]),
                pa.array([raw[a:b] for a, b in zip(start[use], end[use])], pa.binary())],
                ["bucket", "doc", "rank", "name", "body"])
    return run


def suffix_order(bodies: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """The enhanced suffix array of some strings: (string, start) of the suffixes of ``least`` bytes or more, sorted,
    and the length of the common prefix with the one before."""
    size = np.array([len(b) for b in bodies], np.int64)
    width = -(-int(size.max(initial=0)) // 8) * 8 + 8
    grid = np.zeros((len(bodies), width), np.uint8)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    row = np.repeat(np.arange(len(bodies)), size)
    grid[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat + 1  # 0 ends a string; no 255 in UTF-8
    many = np.maximum(size - least + 1, 0)
    string = np.repeat(np.arange(len(bodies)), many)
    start = np.arange(len(string)) - np.repeat(np.cumsum(many) - many, many)
    buffer = np.concatenate([grid.ravel(), np.zeros(width, np.uint8)])
    word = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))
    base = string * width
    keys = []
    for k in range(0, width - 8, 8):
        # Words beyond the string's end are 0.
        keys.append(np.where(start + k < width - 8, word[np.minimum(base + start + k, len(word) - 1)], 0).astype(np.uint64))
    order = np.lexsort(keys[::-1]) if keys else np.zeros(0, np.int64)
    common = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for key in keys:
        a, b = key[order[open_]], key[order[open_ - 1]]
        apart = a ^ b
        equal = apart == 0
        common[open_[equal]] += 8
        rest = open_[~equal]
        bits = np.frexp(apart[~equal].astype(np.float64))[1]
        lead = (64 - np.minimum(bits, 64)) // 8
        common[rest] += lead
        open_ = open_[equal]
    left = size[string[order]] - start[order]
    common[1:] = np.minimum(common[1:], np.minimum(left[1:], left[:-1]))
    return string[order], start[order], common


def repeat_groups(common: list[int], left: list[int], least: int) -> list[tuple[int, int, int]]:
    """Maximal repeats of a stretch of the suffix array by a stack scan: (first, last, length) of every interval whose
    left extensions differ, inner ones first. ``left`` is the byte before a suffix, below 0 where there is none."""
    out: list[tuple[int, int, int]] = []
    stack: list[list[int]] = []  # length, first, the left byte all share (-1: they differ)
    for k in range(1, len(common) + 1):
        length = common[k] if k < len(common) else 0
        if length < least:
            length = 0
        first, shared = k - 1, left[k - 1]
        while stack and stack[-1][0] > length:
            size, first, known = stack.pop()
            known = known if known == shared else -1
            if known < 0:
                out.append((first, k - 1, size))
            shared = known
        if length and stack and stack[-1][0] == length:
            stack[-1][2] = stack[-1][2] if stack[-1][2] == shared else -1
        elif length:
            stack.append([length, first, shared])
    return out


def _repeated(least: int):
    """Of each bucket, the occurrences of maximal repeat groups in documents other than the group's smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "bucket"):
            doc, name = group.column("doc").to_numpy(), group.column("name").to_numpy()
            order = np.lexsort((name, doc))
            fresh = np.ones(len(doc), bool)  # copies of a row
            fresh[1:] = (doc[order][1:] != doc[order][:-1]) | (name[order][1:] != name[order][:-1])
            order = order[fresh]
            doc, name, rank = doc[order], name[order], group.column("rank").to_numpy()[order]
            bodies = group.column("body").take(pa.array(order)).to_pylist()
            string, start, common = suffix_order(bodies, least)
            if len(string) < 2:
                continue
            at = np.cumsum([0] + [len(b) for b in bodies])
            flat = np.frombuffer(b"".join(bodies), np.uint8)
            # A context ends at its start: what stands before it is another anchor's matter.
            left = np.where(start > 0, flat[at[string] + start - 1].astype(np.int64), -1)
            owner = rank[string]
            head = np.flatnonzero(np.concatenate([[True], common[1:] < least]))
            ends = np.concatenate([head[1:], [len(string)]])
            mixed = ((np.minimum.reduceat(owner, head) != np.maximum.reduceat(owner, head))
                     & ((np.minimum.reduceat(left, head) < 0)
                        | (np.minimum.reduceat(left, head) != np.maximum.reduceat(left, head))))
            rows, sizes = [], []
            for a, b in zip(head[mixed].tolist(), ends[mixed].tolist()):
                own = owner[a:b]
                done = np.zeros(b - a, bool)
                for x, y, size in repeat_groups(common[a:b].tolist(), left[a:b].tolist(), least):
                    part = own[x:y + 1]
                    hit = (part > part.min()) & ~done[x:y + 1]
                    if hit.any():
                        done[x:y + 1] |= hit  # inner groups are longer
                        found = np.flatnonzero(hit) + a + x
                        rows.append(found)
                        sizes.append(np.full(len(found), size))
            if rows:
                row, size = np.concatenate(rows), np.concatenate(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[string[row]]), pa.array(name[string[row]]), pa.array(start[row].astype(np.int32)),
                     pa.array(size.astype(np.int32))], ["doc", "name", "start", "size"])
    return run


def _cut(least: int):
    """Which bytes of each text are removed; the rest, and what is known of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _unzipped(batches):
            data, offsets = text_bytes(texts)
            edge = np.zeros(len(data) + 1, np.int64)
            full, part = batch.column("full"), batch.column("names")
            if full.null_count < len(full) or part.null_count < len(part):
                _, doc, start, end, gram, context = anchors(data, offsets, least)
                tag = _tagged(doc, identity(gram, context).view(np.int64))
                hit = np.isin(tag, _tagged(*_flat(full)))
                np.add.at(edge, start[hit], 1)
                np.add.at(edge, end[hit], -1)
                row, name = _flat(part)
                known = _tagged(row, name)
                order = np.argsort(known, kind="stable")
                known = known[order]
                begin, size = (_flat(batch.column(c))[1][order] for c in ("starts", "sizes"))
                a, b = np.searchsorted(known, tag), np.searchsorted(known, tag, "right")
                many = b - a
                which = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(many.sum())
                from_ = np.repeat(start, many) + begin[which]
                np.add.at(edge, from_, 1)
                np.add.at(edge, from_ + size[which], -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = data[~gone].tobytes()
            sums = np.concatenate([[0], np.cumsum(gone)])
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            inner = offsets[:-1][np.diff(offsets) > 0]
            first[inner] = gone[inner]  # spans end with their text
            spans = np.concatenate([[0], np.cumsum(first)])
            removed = sums[offsets[1:]] - sums[offsets[:-1]]
            to = offsets - sums[offsets]
            rest = [kept[a:b] for a, b in zip(to, to[1:])]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(k) for k, c in enumerate(batch.schema.names) if c not in _OWN),
                pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans[offsets[1:]] - spans[offsets[:-1]]),
                pa.array([hashlib.sha256(r).hexdigest() for r in rest]),
                pa.array([r.decode("utf-8", "ignore") for r in rest])],
                [*(c for c in batch.schema.names if c not in _OWN),
                 "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


_OWN = ("i", "r", "z", "full", "compare", "names", "starts", "sizes")


def _order_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def remove_repeats(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """Every row with ``n_bytes, n_removed, n_spans, kept_sha256, kept``; ``keep`` names the columns that stay.

    A byte is removed where a string of ``least`` bytes that covers it starts
    in a document with a smaller id as well. ``kept`` is the text that is
    left, without letters of which only some bytes are.
    """
    keep = [id_col] if keep is None else keep
    inner = {c: f"c{k}" for k, c in enumerate(keep)}
    carried = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in inner.items())
    head = carried + ", " if carried else ""
    many = partitions(docs)
    texts = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], _order_key(id_col).alias("i"),
                        # Flags belong to a row: rows of one id, or without any, do not carry each other's.
                        F.xxhash64(_order_key(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("r"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    packed = texts.mapInArrow(slim(_packed), f"{head}i long, r long, z binary").where("r is not null")  # never: the joins infer it
    judged = (texts.select("i", "r", "t")
              .mapInArrow(slim(_dealt(least, many)),
                          "bucket long, ids binary, ranks binary, counts binary, grams binary, contexts binary")
              .repartition(many, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(slim(_judged), "doc long, whole boolean, names array<long>"))
    flags = judged.groupBy("doc").agg(
        F.flatten(F.collect_list(F.when(F.col("whole"), F.col("names")))).alias("full"),
        F.flatten(F.collect_list(F.when(~F.col("whole"), F.col("names")))).alias("compare"))
    # The texts and flags below are read twice with all their columns, so both are shuffled once.
    known = packed.join(flags, F.col("r") == F.col("doc"), "left").drop("doc")
    spans = (known.where(F.size("compare") > 0)
             .mapInArrow(slim(_contexts(least, many)), "bucket long, doc long, rank long, name long, body binary")
             .repartition(many, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(slim(_repeated(least)), "doc long, name long, start int, size int")
             .groupBy("doc").agg(F.collect_list(F.struct("name", "start", "size")).alias("s"))
             .select("doc", F.col("s.name").alias("names"), F.col("s.start").alias("starts"),
                     F.col("s.size").alias("sizes")))
    cut = (known.join(spans, F.col("r") == F.col("doc"), "left")
           .select(*inner.values(), "i", "r", "z", "full", "compare", "names", "starts", "sizes")
           .mapInArrow(slim(_cut(least)), f"{head}n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"))
    return cut.select(*[F.col(n).alias(c) for c, n in inner.items()],
                      "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
