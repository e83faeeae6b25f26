"""Suffix-array dedup: bytes of strings that also start earlier, by difference covers.

Texts are taken as UTF-8 bytes, a null as an empty text. A string of `LENGTH` (100)
bytes within one text is a repeat if the same string starts earlier: in a row of a
smaller doc_id (null ids first), or in the same text further left. Every byte that a
repeat covers is removed; strings are judged on the input.

Two positions of a text have a cover sample at the same distance ahead, below
`PERIOD` (57), if positions whose remainder modulo 57 lies in a difference cover are
sampled: the differences of its eight members give every remainder. So of two equal
strings both have a sample at one distance d, and are equal if the d bytes before the
samples are and the ranks of the sampled suffixes, down to depth LENGTH - d, are.

1. Texts are packed into chunks. Each chunk sends the names (hashes) of its samples'
   first `NAME` (44) bytes, each once; a name found in no other place rules all
   strings out that lean on it, which leaves a small part of the samples.
2. What the strings that lean on a sample can reach, 56 bytes on either side of the
   name, is its context. Chunks send one hash per distinct context. Of samples with
   equal contexts all but the first repeat it in every string; a name with one context
   is done. So copies, however many, cost a hash per chunk, and only contexts that
   differ around a shared name, one sample each, are sorted.
3. Suffix buckets: these samples are dealt by name with their contexts. A bucket is
   sorted alone, a slice of names at a time: once by the suffixes from the sample on,
   once by what lies before it, read backward, both with the common prefix of
   neighbours. From these come, for every distance d, the rank of the sample to depth
   LENGTH - d and the rank of the d bytes before it; the ties that remain are equal
   strings, and all but the earliest are repeats.
4. A name with more than `HOT` contexts would make one large bucket; its strings are
   dealt one by one by a 128-bit hash of the whole string instead.

Names and contexts are told apart by more than 96 bits of hash together, strings in buckets by
their bytes. Memory is bounded by a chunk, a bucket of names and `HOT` contexts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.chunks import BASE, CHUNK_BYTES, Hasher, bucketed, mixed, next_chunk, ragged
from gleanery.llm.common import written

LENGTH = 100
#: A perfect difference set. Every remainder modulo 57 but 0 is one difference of two of these.
COVER = (1, 2, 4, 14, 33, 37, 44, 53)
PERIOD = 57
NAME = LENGTH - PERIOD + 1
#: Bytes around a name that a string leaning on it can reach.
SIDE = PERIOD - 1
#: Bytes of text for which there is one bucket of names.
BUCKET_BYTES = 8 << 20
#: Samples sorted at a time; a name is not divided.
SLICE = 1 << 16
#: Contexts of one name up to which they are dealt by it.
HOT = 100_000

#: A text's place in the order of texts.
_DOC = np.dtype([("id", "<i8"), ("hash", "<u8"), ("some", "u1"), ("doc", "<u4")])
#: What becomes of a context: its strings repeat an earlier sample's, are sorted with its bucket, or are dealt one by one.
REPEATED, SORTED, SINGLE = 1, 2, 3
#: What is sent about a sample besides its bytes. As columns, which compress better than rows.
_SAMPLE = {"doc": "<u4", "at": "<u4", "member": "<u4", "left": "u1", "right": "u1"}
_PACKED = "chunk long, ids array<long>, hashes array<long>, sizes array<long>, data binary"
_NAMES = "bucket int, chunk long, names binary"
_SHARED = "chunk long, bucket int, shared binary"
_CONTEXTS = "bucket int, chunk long, names binary, contexts binary, doc binary, docs binary"
_STATES = "chunk long, bucket int, names binary, states binary"
_DEALT = "bucket int, chunk long, kind int, bytes binary, samples binary, docs binary"
_MASKS = "chunk long, kind int, members binary, masks binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary"


def _pack(chunk_bytes: int):
    def pack(batches):
        numbers, ids, hashes, texts, size = next_chunk(), [], [], [], 0

        def row():
            return pa.RecordBatch.from_pylist([{
                "chunk": next(numbers), "ids": ids, "hashes": hashes,
                "sizes": [len(t) for t in texts], "data": b"".join(texts)}], schema=schema)

        schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())),
                            ("sizes", pa.list_(pa.int64())), ("data", pa.binary())])
        for batch in batches:
            for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("id", "hash", "text")), strict=True):
                if texts and size + len(text) > chunk_bytes:
                    yield row()
                    ids, hashes, texts, size = [], [], [], 0
                ids.append(i)
                hashes.append(h)
                texts.append(text)
                size += len(text)
        if texts:
            yield row()
    return pack


@lru_cache(2)
def _hasher(seed: int) -> Hasher:
    return Hasher(seed)


class _Chunk:
    """The texts of a chunk and their samples."""

    def __init__(self, table: pa.Table):
        row = table.slice(0, 1)
        self.number = row.column("chunk")[0].as_py()
        ids = row.column("ids").combine_chunks().flatten()
        self.some = np.asarray(ids.is_valid())
        self.ids = np.asarray(ids.fill_null(0))
        self.hashes = np.asarray(row.column("hashes").combine_chunks().flatten()).view(np.uint64)
        self.sizes = np.asarray(row.column("sizes").combine_chunks().flatten())
        self.data = np.frombuffer(row.column("data")[0].as_buffer(), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.rank = np.empty(len(self.ids), np.int64)
        self.rank[np.lexsort((np.arange(len(self.ids)), self.hashes, self.ids, self.some))] = np.arange(len(self.ids))

    def places(self, docs: np.ndarray) -> bytes:
        """What orders these texts."""
        out = np.zeros(len(docs), _DOC)
        out["id"], out["hash"], out["some"], out["doc"] = self.ids[docs], self.hashes[docs], self.some[docs], docs
        return out.tobytes()

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Where samples lie that a string can lean on, ascending, and the texts they are in."""
        count = np.where(self.sizes >= LENGTH, self.sizes - NAME + 1, 0)
        full, rest = np.divmod(count, PERIOD)
        cover = np.array(COVER)
        n = full * len(COVER) + np.searchsorted(cover, rest)
        doc = np.repeat(np.arange(len(n)), n)
        k = ragged(np.zeros(len(n), np.int64), n)
        return self.starts[doc] + k // len(COVER) * PERIOD + cover[k % len(COVER)], doc

    def codes(self, at: np.ndarray, buckets: int) -> np.ndarray:
        """The names at these positions: the bucket, then 32 bits."""
        h = _hasher(0).at(self.data, at, NAME)
        return ((h & np.uint64(0xFFFFFF)) * np.uint64(buckets) >> np.uint64(24) << np.uint64(32)) | (h >> np.uint64(32))


def _low(codes: np.ndarray) -> bytes:
    """The part of names that tells them apart within a bucket."""
    return codes.astype("<u4").tobytes()


def _name(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.uint64)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _rows(rows: list[tuple], fields: list[tuple]) -> pa.Table:
    schema = pa.schema(fields)
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(
        zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _by_bucket(codes: np.ndarray, buckets: int):
    """The slices of ascending codes that lie in one bucket."""
    cuts = np.searchsorted(codes, np.arange(buckets + 1).astype(np.uint64) << np.uint64(32))
    for bucket in np.flatnonzero(np.diff(cuts)):
        yield int(bucket), slice(cuts[bucket], cuts[bucket + 1])


def _names(buckets: int):
    fields = [("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary())]

    def names(table: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        codes = _counted(chunk.codes(chunk.samples()[0], buckets))[0]
        return _rows([(bucket, chunk.number, _low(codes[part])) for bucket, part in _by_bucket(codes, buckets)], fields)
    return names


def _shared(table: pa.Table) -> pa.Table:
    fields = [("chunk", pa.int64()), ("bucket", pa.int32()), ("shared", pa.binary())]
    lists = [_name(x) for x in table.column("names").to_pylist()]
    known, times = _counted(np.concatenate(lists))
    known = known[times > 1]
    bucket = table.column("bucket")[0].as_py()
    return _rows([(number, bucket, _low(names[_among(names, known)])) for number, names in zip(
        table.column("chunk").to_pylist(), lists, strict=True)], fields)


def _among(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(codes), bool)
    return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes


class _Members:
    """The samples of a chunk whose names are found elsewhere, by name and context."""

    def __init__(self, chunk: _Chunk, buckets: int, shared: np.ndarray):
        at, doc = chunk.samples()
        codes = chunk.codes(at, buckets)
        known, counts = _counted(codes)
        mine = np.flatnonzero(_among(codes, np.union1d(known[counts > 1], shared)))
        at, doc, codes = at[mine], doc[mine], codes[mine]
        left = np.minimum(at - chunk.starts[doc], SIDE)
        right = np.minimum(chunk.ends[doc] - at - NAME, SIDE)
        # Positions less what lies before them ascend, but for those near the start of a text.
        begin = at - left
        order = np.argsort(begin, kind="stable")
        context = np.empty(len(at), np.uint64)
        context[order] = _hasher(3).at(chunk.data, begin[order], (left + NAME + right)[order])
        context = mixed(context ^ (left << 8 | right).astype(np.uint64) * np.uint64(BASE))
        place = chunk.rank[doc] * (int(chunk.sizes.max(initial=0)) + 1) + at - chunk.starts[doc]
        order = np.lexsort((place, context, codes))
        self.at, self.doc, self.codes, self.context = at[order], doc[order], codes[order], context[order]
        first = np.ones(len(at), bool)
        first[1:] = (self.codes[1:] != self.codes[:-1]) | (self.context[1:] != self.context[:-1])
        #: The first sample of each context, and for every sample which context it has.
        self.first, self.which = np.flatnonzero(first), np.cumsum(first) - 1


def _contexts(buckets: int):
    fields = [("bucket", pa.int32()), ("chunk", pa.int64()),
              *[(c, pa.binary()) for c in ("names", "contexts", "doc", "docs")]]

    def contexts(key, table: pa.Table, shared: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        found = [np.uint64(b) << np.uint64(32) | _name(x) for b, x in zip(
            shared.column("bucket").to_pylist(), shared.column("shared").to_pylist(), strict=True)]
        common = np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))
        members, rows = _Members(chunk, buckets, common), []
        codes = members.codes[members.first]
        known, counts = _counted(codes)
        sent = _among(codes, np.union1d(known[counts > 1], common))  # other names have one context here and no other chunk
        one, codes = members.first[sent], codes[sent]
        for bucket, part in _by_bucket(codes, buckets):
            docs, doc = np.unique(members.doc[one[part]], return_inverse=True)
            rows.append((bucket, chunk.number, _low(codes[part]), members.context[one[part]].astype("<u8").tobytes(),
                         doc.astype("<u4").tobytes(), chunk.places(docs)))
        return _rows(rows, fields)
    return contexts


def _ranks(numbers: np.ndarray, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each text in the order of texts, the same in all rows, and where those of each row begin."""
    docs = [np.frombuffer(x, _DOC) for x in docs]
    base = np.cumsum([0, *(len(x) for x in docs)])
    all_ = np.concatenate(docs)
    keys = [all_["doc"], np.repeat(numbers, np.diff(base)), all_["hash"], all_["id"], all_["some"]]
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    rank = np.empty(len(all_), np.int64)
    rank[order] = np.cumsum(new)
    return rank, base


def _joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _states(hot: int):
    fields = [("chunk", pa.int64()), ("bucket", pa.int32()), ("names", pa.binary()), ("states", pa.binary())]

    def states(table: pa.Table) -> pa.Table:
        numbers = np.asarray(table.column("chunk"))
        rank, base = _ranks(numbers, table.column("docs").to_pylist())
        sizes = [len(x) // 4 for x in table.column("names").to_pylist()]
        row = np.repeat(np.arange(len(sizes)), sizes)
        name, context = _joined(table, "names", "<u4"), _joined(table, "contexts", "<u8")
        order = np.lexsort((rank[base[row] + _joined(table, "doc", "<u4")], context, name))
        name, context = name[order], context[order]
        new_name = np.concatenate([[True], name[1:] != name[:-1]])
        new = new_name | np.concatenate([[True], context[1:] != context[:-1]])
        group = np.cumsum(new_name) - 1
        count = np.bincount(group, weights=new)[group]
        sorted_ = np.where(~new, REPEATED, np.where(count > hot, SINGLE, np.where(count > 1, SORTED, 0))).astype(np.uint8)
        # A name all of whose contexts are done is not told; of the others every context is, in the order it came.
        told = np.bincount(group, weights=sorted_)[group] > 0
        state, say = np.empty(len(order), np.uint8), np.empty(len(order), bool)
        state[order], say[order] = sorted_, told
        name = _joined(table, "names", "<u4")
        bucket, starts = table.column("bucket")[0].as_py(), np.cumsum([0, *sizes])
        rows = []
        for i, number in enumerate(numbers):
            part = np.flatnonzero(say[starts[i]:starts[i + 1]]) + starts[i]
            if len(part):
                rows.append((int(number), bucket, name[part].tobytes(), state[part].tobytes()))
        return _rows(rows, fields)
    return states


def _valid(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bit d: the string that starts d bytes before the sample lies within the text."""
    low, high = (SIDE - right).astype(np.uint64), left.astype(np.uint64) + np.uint64(1)
    one = np.uint64(1)
    return np.where(low < high, (one << high) - (one << low), np.uint64(0))


def _sorted_bytes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and the common prefix of each with the one before."""
    rows = np.ascontiguousarray(rows)
    order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a = rows[order]
        differ = a[1:] != a[:-1]
        common[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, common


def repeats(context: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Bit d of each sample: the string d bytes before it equals one of a sample of smaller rank.

    context: `SIDE` bytes, the name, `SIDE` bytes, of which left and right lie in the text.
    Fewer than 2^21 samples.
    """
    m = len(context)
    if m >= 1 << 21:
        raise ValueError("too many samples at a time")
    by_suffix, common = _sorted_bytes(context[:, SIDE:])
    by_prefix, common_before = _sorted_bytes(context[:, SIDE - 1::-1])
    place = np.empty(m, np.int64)
    place[by_prefix] = np.arange(m)
    place = place[by_suffix]
    valid = _valid(left, right)[by_suffix]
    first = np.empty(m, np.int64)
    first[np.argsort(rank, kind="stable")] = np.arange(m)
    first = first[by_suffix]
    owner = np.argsort(first)
    masks = np.zeros(m, np.uint64)
    for d in range(PERIOD):
        bit = np.uint64(1 << d)
        suffix = np.cumsum(common < LENGTH - d)
        before = np.cumsum(common_before < d)[place] if d else 0
        key = ((suffix << 42) | (before << 21) | first)[(valid & bit) > 0]
        key.sort()
        tied = np.flatnonzero(key[1:] >> 21 == key[:-1] >> 21) + 1
        masks[owner[key[tied] & ((1 << 21) - 1)]] |= bit
    out = np.empty(m, np.uint64)
    out[by_suffix] = masks
    return out


def _sliced(starts: np.ndarray, total: int):
    """Slices of about `SLICE` rows that begin at some of these starts."""
    a = 0
    while a < total:
        k = np.searchsorted(starts, a + SLICE, "right") - 1
        b = starts[k] if k >= 0 and starts[k] > a else None
        if b is None:
            k = np.searchsorted(starts, a, "right")
            b = starts[k] if k < len(starts) else total
        if total - a <= SLICE:
            b = total
        yield a, b
        a = b


def _deal(buckets: int):
    fields = [("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()),
              *[(c, pa.binary()) for c in ("bytes", "samples", "docs")]]

    def deal(key, table: pa.Table, states: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        found = states.sort_by("bucket")
        codes = np.concatenate([np.zeros(0, np.uint64), *(np.uint64(b) << np.uint64(32) | _name(x) for b, x in zip(
            found.column("bucket").to_pylist(), found.column("names").to_pylist(), strict=True))])
        members = _Members(chunk, buckets, np.unique(codes))
        # The contexts of the names told are in the order in which they were sent.
        state = np.zeros(len(members.first), np.uint8)
        state[_among(members.codes[members.first], np.unique(codes))] = _joined(found, "states", "u1")

        masks, rows = np.zeros(len(members.at), np.uint64), []
        later = np.ones(len(members.at), bool)
        later[members.first] = state == REPEATED
        left = np.minimum(members.at - chunk.starts[members.doc], SIDE).astype(np.uint8)
        right = np.minimum(chunk.ends[members.doc] - members.at - NAME, SIDE).astype(np.uint8)
        masks[later] = _valid(left[later], right[later])
        padded = np.concatenate([np.zeros(SIDE, np.uint8), chunk.data, np.zeros(SIDE + NAME, np.uint8)])
        views = np.lib.stride_tricks.sliding_window_view(padded, NAME + 2 * SIDE)
        for kind in (SORTED, SINGLE):
            go = members.first[state == kind]
            home = (members.codes[go] >> np.uint64(32)).astype(np.int64)
            for part in np.split(go, np.flatnonzero(np.diff(home)) + 1):
                if not len(part):
                    continue
                docs, doc = np.unique(members.doc[part], return_inverse=True)
                context = views[members.at[part]]
                sample = {"doc": doc, "at": members.at[part] - chunk.starts[members.doc[part]], "member": part,
                          "left": left[part], "right": right[part]}
                if kind == SORTED:
                    bucket = int(members.codes[part[0]] >> np.uint64(32))
                    rows.append((bucket, chunk.number, 0, context.tobytes(), _columns(sample), chunk.places(docs)))
                else:
                    rows.extend(_strings(chunk.number, context, sample, chunk.places(docs), buckets))
        own = np.flatnonzero(masks | np.isin(np.arange(len(masks)), members.first[state > REPEATED]))
        if len(own):
            rows.append((-1 - chunk.number % buckets, chunk.number, 1, np.stack([own, members.at[own]]).astype("<u4").tobytes(),
                         masks[own].tobytes(), b""))
        return _rows(rows, fields)
    return deal


def _columns(sample: dict[str, np.ndarray]) -> bytes:
    return b"".join(sample[c].astype(kind).tobytes() for c, kind in _SAMPLE.items())


def _samples(table: pa.Table) -> dict[str, np.ndarray]:
    """The samples of all rows, with their chunks and `rank`, that of their text and place."""
    parts, width = table.column("samples").to_pylist(), sum(np.dtype(k).itemsize for k in _SAMPLE.values())
    out, at, sizes = {}, 0, [len(x) // width for x in parts]
    for c, kind in _SAMPLE.items():
        item = np.dtype(kind).itemsize
        out[c] = np.concatenate([np.frombuffer(x[at * n:(at + item) * n], kind) for x, n in zip(parts, sizes, strict=True)])
        at += item
    numbers = np.asarray(table.column("chunk"))
    rank, base = _ranks(numbers, table.column("docs").to_pylist())
    row = np.repeat(np.arange(len(sizes)), sizes)
    out["chunk"], out["text"] = numbers[row], rank[base[row] + out["doc"]]
    return out


def _strings(number: int, context: np.ndarray, sample: dict[str, np.ndarray], docs: bytes, buckets: int):
    """Rows with one entry for each string that leans on these samples, dealt by 128 bits of hash.

    An entry's `at` is where the string starts, its `left` the distance to the sample.
    """
    begin, data, found = np.arange(len(context)) * context.shape[1], context.reshape(-1), []
    valid = _valid(sample["left"], sample["right"])
    for d in range(PERIOD):
        rows = np.flatnonzero(valid & np.uint64(1 << d))
        p = begin[rows] + SIDE - d
        found.append((_hasher(1).at(data, p, LENGTH), _hasher(2).at(data, p, LENGTH), rows, np.full(len(rows), d)))
    k1, k2, rows, d = (np.concatenate(x) for x in zip(*found, strict=True))
    entry = {c: sample[c][rows] for c in _SAMPLE} | {"at": sample["at"][rows] - d, "left": d}
    home = ((k1 >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
        if len(part):
            yield (buckets + int(home[part[0]]), number, 2, np.stack([k1[part], k2[part]]).tobytes(),
                   _columns({c: entry[c][part] for c in _SAMPLE}), docs)


def _masks(chunks: np.ndarray, members: np.ndarray, masks: np.ndarray) -> list[tuple]:
    keep = np.flatnonzero(masks)
    keep = keep[np.argsort(chunks[keep], kind="stable")]
    return [(int(chunks[part[0]]), 0, members[part].astype("<u4").tobytes(), masks[part].tobytes())
            for part in np.split(keep, np.flatnonzero(np.diff(chunks[keep])) + 1) if len(part)]


def _solve(table: pa.Table) -> pa.Table:
    """One bucket: samples of some names, single strings of hot names, or a chunk's own masks passed on."""
    fields = [("chunk", pa.int64()), ("kind", pa.int32()), ("members", pa.binary()), ("masks", pa.binary())]
    kind, rows = table.column("kind")[0].as_py(), []
    if kind == 1:
        rows = list(zip(table.column("chunk").to_pylist(), [1] * len(table),
                        table.column("bytes").to_pylist(), table.column("samples").to_pylist(), strict=True))
    elif kind == 2:
        x = _samples(table)
        keys = [np.frombuffer(b, "<u8").reshape(2, -1) for b in table.column("bytes").to_pylist()]
        k1, k2 = np.concatenate(keys, axis=1)
        order = np.lexsort((x["at"], x["text"], k2, k1))
        new = np.ones(len(order), bool)
        new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        # The same string comes once for every sample it has.
        later = order[(x["text"][order] != x["text"][head]) | (x["at"][order] != x["at"][head])]
        rows = _masks(x["chunk"][later], x["member"][later], np.uint64(1) << x["left"][later].astype(np.uint64))
    else:
        x = _samples(table)
        context = _joined(table, "bytes", "u1").reshape(-1, NAME + 2 * SIDE)
        rank = np.empty(len(context), np.int64)
        rank[np.lexsort((x["at"], x["text"]))] = np.arange(len(rank))
        order = np.argsort(np.ascontiguousarray(context[:, SIDE:SIDE + NAME]).view(f"S{NAME}").ravel(), kind="stable")
        name = context[order, SIDE:SIDE + NAME]
        new = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]).any(1)]))
        masks = np.zeros(len(context), np.uint64)
        for a, b in _sliced(new, len(context)):
            part = order[a:b]
            masks[part] = repeats(context[part], x["left"][part], x["right"][part], rank[part])
        rows = _masks(x["chunk"], x["member"], masks)
    return _rows(rows, fields)


def _cut(key, table: pa.Table, found: pa.Table) -> pa.Table:
    """The texts of a chunk without the bytes that repeats cover."""
    chunk = _Chunk(table)
    kinds = found.column("kind").to_pylist()
    members, masks = (found.column(c).to_pylist() for c in ("members", "masks"))
    own = next((i for i, k in enumerate(kinds) if k == 1), None)
    data, total = chunk.data, len(chunk.data)
    covered = np.zeros(total, bool)
    if own is not None:
        numbers, at = np.frombuffer(members[own], "<u4").reshape(2, -1).astype(np.int64)
        all_ = np.frombuffer(masks[own], "<u8").copy()
        for i, k in enumerate(kinds):
            if k != 1:
                np.bitwise_or.at(all_, np.searchsorted(numbers, np.frombuffer(members[i], "<u4")), np.frombuffer(masks[i], "<u8"))
        starts = np.zeros(total + 1, np.int32)
        for d in range(PERIOD):
            starts[at[(all_ & np.uint64(1 << d)) > 0] - d] = 1
        sums = np.cumsum(starts)
        covered = sums[:total] > np.concatenate([np.zeros(min(LENGTH, total), sums.dtype), sums[:max(total - LENGTH, 0)]])
    lost = np.concatenate([[0], np.cumsum(covered)])
    removed = lost[chunk.ends] - lost[chunk.starts]
    edge = np.zeros(total + 1, bool)
    edge[chunk.starts] = True  # a run ends with its text
    begin = np.flatnonzero(covered & (edge[:total] | ~np.concatenate([[False], covered[:-1]])))
    end = np.flatnonzero(covered & (edge[1:] | ~np.concatenate([covered[1:], [False]]))) + 1 if total else begin
    edges = np.searchsorted(begin, np.append(chunk.starts, total))
    shift = np.repeat(chunk.starts, np.diff(edges))
    kept = data[~covered]
    offsets = np.append(chunk.starts - lost[chunk.starts], total - lost[total]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(begin - shift, pa.int64()), pa.array(end - shift, pa.int64())],
                                       fields=[pa.field("start", pa.int64()), pa.field("stop", pa.int64())])
    return pa.table({
        "doc_id": pa.array(chunk.ids, pa.int64(), mask=~chunk.some), "n_bytes": pa.array(chunk.sizes, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans),
        "kept": pa.Array.from_buffers(pa.binary(), len(chunk.sizes), [None, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes())])})


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                   hot: int = HOT) -> DataFrame:
    """Per row of docs (doc_id an integer, text): n_bytes, n_removed, the removed spans (byte offsets, maximal runs) and `kept`, the bytes left.

    What is left of a text may begin or end within a character, so it is binary. A null
    or empty text has no bytes. Null ids are the smallest; rows that share an id come
    in the order of a hash of their texts, and of rows equal in both one counts as
    earlier. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    chunks = bucketed(rows.mapInArrow(_pack(chunk_bytes), _PACKED))
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = min(1 << 22, 1 + total // bucket_bytes)
    by_chunk = chunks.groupBy("chunk")
    shared = by_chunk.applyInArrow(_names(buckets), _NAMES).groupBy("bucket").applyInArrow(_shared, _SHARED)
    states = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_contexts(buckets), _CONTEXTS).groupBy(
        "bucket").applyInArrow(_states(hot), _STATES)
    states = written(states)
    dealt = by_chunk.cogroup(states.groupBy("chunk")).applyInArrow(_deal(buckets), _DEALT)
    masks = dealt.groupBy("bucket").applyInArrow(_solve, _MASKS)
    return by_chunk.cogroup(masks.groupBy("chunk")).applyInArrow(_cut, _RESULT)
