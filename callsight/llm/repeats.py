"""Removal of byte strings that documents with smaller ids also hold.

Every byte covered by a string of ``size`` bytes that also starts in a
document with a smaller id goes; strings are judged on the input.

The suffixes worth sorting are found by content: in every string of ``size``
bytes the ``anchor`` bytes with the smallest hash are its anchor, so equal
strings share an anchor at the same place (a sparse suffix array: about one
position in 16).  Batches of documents send their distinct anchor hashes to
hash buckets; only anchors of two or more documents come back.  For those a
batch sends each distinct context (the bytes that strings around the anchor
can cover) once, with its smallest and largest document.  Occurrences never
leave their batch: it gets back the smallest document of each group and looks
its own places up again.

A bucket builds an enhanced suffix array over its distinct contexts: suffixes
sorted from the anchor on, with their common-prefix lengths.  The scan opens
an interval wherever the common prefix reaches a depth and closes it where it
falls below (all intervals of one depth in one vector step, depths in turn);
reversed prefixes sorted the same way give the left extensions.  An interval
whose members differ on the left is split by left extension, so what remains
are the groups of all occurrences of one repeated string, not only pairs of
neighbours; the smallest document of each group decides.

Sizes: a batch is about ``batch_bytes`` of text and a bucket about
``bucket_bytes``; both numbers follow the input.  In a batch an anchor or a
context counts once however many documents share it, so a hot passage sends
one entry per batch, not one per occurrence.  An anchor that stands at more
than ``dense`` places (a common short line, say, in ever different
surroundings) is dealt out again: each string around it goes to the bucket of
its own bytes, so what meets in a bucket is equal as a whole.

Defined cases: a NULL text is empty; texts shorter than ``size`` stay whole;
rows with a NULL id are neither source nor target; rows that share an id do
not remove from each other; an empty table gives an empty result; all caller's
columns come back in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MULTIPLIER, blocks, bytes_view, mix64


def _slide(a: np.ndarray, w: int, f) -> np.ndarray:
    """f over every window of ``w`` entries, by doubling."""
    m, s = a, 1
    while s * 2 <= w:
        m = f(m[:-s], m[s:])
        s *= 2
    return f(m[:len(m) - (w - s)], m[w - s:]) if s < w else m


def _gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` bytes, by doubling."""
    h = mix64(b.astype(np.uint64) + np.uint64(1))
    by, s = {1: h}, 1
    while s * 2 <= k:
        h = h[:-s] * np.uint64(pow(MULTIPLIER, s, 1 << 64)) + h[s:]
        s *= 2
        by[s] = h
    out, used = by[s], s
    n = len(b) - k + 1
    out = out[:n]
    while used < k:
        p = 1 << ((k - used).bit_length() - 1)
        out = out * np.uint64(pow(MULTIPLIER, p, 1 << 64)) + by[p][used:used + n]
        used += p
    return mix64(out)


def find_anchors(data: np.ndarray, off: np.ndarray, size: int, k: int):
    """(position, hash, row) of every anchor of a string of ``size`` bytes inside a row."""
    w = size - k + 1
    pos, hashes, rows = [], [], []
    for i, j in blocks(off, 1 << 18):
        part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        if len(part) < size:
            continue
        h = _gram_hashes(part, k)
        least = _slide(h, w, np.minimum)
        inside = np.ones(len(least), bool)                 # strings that do not cross rows
        for cut in o[1:-1].tolist():
            inside[max(0, cut - size + 1):cut] = False
        least = np.where(inside, least, np.uint64(0))
        pad = np.zeros(w - 1, np.uint64)
        picked = np.flatnonzero(_slide(np.concatenate([pad, least, pad]), w, np.maximum) == h)
        pos.append(picked + off[i])
        hashes.append(h[picked])
        rows.append(np.searchsorted(o, picked, side="right") - 1 + i)
    if not pos:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z
    return np.concatenate(pos), np.concatenate(hashes), np.concatenate(rows)


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of bytes -> (order, common-prefix length with the row before, place of each row): a suffix array with LCPs."""
    n, width = keys.shape
    pad = (-width) % 8
    wide = np.concatenate([keys, np.zeros((n, pad), np.uint8)], axis=1) if pad else keys
    cols = np.ascontiguousarray(wide).view(">u8").astype(np.uint64)
    order = np.lexsort(cols.T[::-1])
    s = keys[order]
    differ = s[1:] != s[:-1]
    lcp = np.zeros(n, np.int64)
    lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, lcp, place


def repeat_spans(key, left, ctx, n_left, n_right, least, size: int):
    """Distinct contexts -> per context and depth the smallest document of the repeat group.

    ``ctx[i]`` holds ``left`` bytes before the anchor and ``size`` from it on
    (``n_left``/``n_right`` of them real), ``key`` the anchor's hash, ``least``
    the context's smallest document.  Result (n, left + 1): entry o is the
    smallest document with the string that starts o bytes before the anchor.
    """
    n = len(key)
    head = key.astype(">u8").view(np.uint8).reshape(n, 8)
    _, r_lcp, r_place = _classes(np.concatenate([head, ctx[:, left:]], axis=1))
    _, l_lcp, l_place = _classes(ctx[:, :left][:, ::-1])
    out = np.full((n, left + 1), np.iinfo(np.int64).max)
    for o in range(left + 1):
        ok = np.flatnonzero((n_left >= o) & (n_right >= size - o))
        if not len(ok):
            continue
        node = np.cumsum(r_lcp < 8 + size - o)[r_place[ok]]      # intervals of the tree at this depth
        side = np.cumsum(l_lcp < o)[l_place[ok]] if o else np.zeros(len(ok), np.int64)
        group = node * np.int64(n + 1) + side                    # split by left extension
        by = np.lexsort((least[ok], group))
        g = group[by]
        first = np.concatenate([[True], g[1:] != g[:-1]])
        out[ok[by], o] = least[ok][by][first][np.cumsum(first) - 1]
    return out


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True) if a.size else b""


def _unpack(raw: bytes, kind, count: int) -> np.ndarray:
    if not count:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(raw, decompressed_size=count * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


NONE = np.iinfo(np.int64).max
SLICE = 8192            # records worked on at a time


def _table(rows: list[tuple], kinds: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], [name for name, _ in kinds])


def _distinct(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of bytes and which of them each row is."""
    width = rec.shape[1]
    uniq, which = np.unique(np.ascontiguousarray(rec).view(np.dtype((np.void, width))).reshape(-1), return_inverse=True)
    return uniq.view(np.uint8).reshape(-1, width), which


def _keys(rec: np.ndarray) -> np.ndarray:
    """The anchor hashes at the head of context records."""
    return np.ascontiguousarray(rec[:, :8]).view(">u8").reshape(-1).astype(np.uint64)


def _rank(keys: np.ndarray) -> np.ndarray:
    """Place of each entry among its equals in a sorted array."""
    return np.arange(len(keys)) - np.searchsorted(keys, keys)


def _extremes(which, low, high, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value per class."""
    a, z = np.full(n, NONE), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(a, which, low)
    np.maximum.at(z, which, high)
    return a, z


def _row_hash(rec: np.ndarray) -> np.ndarray:
    """64-bit hash of every row of bytes."""
    pad = np.zeros((len(rec), -rec.shape[1] % 8), np.uint8)
    h = np.zeros(len(rec), np.uint64)
    for col in np.ascontiguousarray(np.concatenate([rec, pad], axis=1)).view(np.uint64).T:
        h = mix64(h * np.uint64(MULTIPLIER) + col)
    return h


def _ordered(table: pa.Table):
    """A batch's ids, row numbers and texts in an order that does not depend on how it arrived."""
    table = table.sort_by([("id", "ascending"), ("tie", "ascending")])
    data, off = bytes_view(table.column("text"))
    ids = table.column("id").combine_chunks()
    known = np.array(ids.is_valid())
    return table, ids.fill_null(0).to_numpy(zero_copy_only=False), known, data, off


def whole_characters(kept: bytes, cuts: list[int]) -> bytes:
    """``kept`` without the bytes of UTF-8 characters that a cut (a place in ``kept``) has split."""
    out = []
    for begin, end in zip([0, *cuts], [*cuts, len(kept)]):
        if begin in cuts:                                              # a cut lies before this part
            while begin < end and kept[begin] & 0xC0 == 0x80:
                begin += 1
        if end in cuts:                                                # and after it
            lead = next((i for i in range(end - 1, max(end - 5, begin - 1), -1) if kept[i] & 0xC0 != 0x80), None)
            if lead is not None and kept[lead] >= 0xC0 and end - lead < (2 if kept[lead] < 0xE0 else 3 if kept[lead] < 0xF0 else 4):
                end = lead
        out.append(kept[begin:end])
    return b"".join(out)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 50, anchor: int = 20,
                   batch_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20, dense: int = 100000, keep=None,
                   characters: bool = False) -> DataFrame:
    """``row`` (the kept columns), ``n_bytes``, ``kept`` (remaining bytes), ``spans`` (removed start, end).
    With ``characters`` the bytes of UTF-8 characters that a span has split are not in ``kept`` either; this is done where
    the spans are cut out, as a second Python function over the result would be a second worker beside each task."""
    left_width = size - anchor
    names = docs.columns if keep is None else keep
    text = F.coalesce(docs[f"`{text_col}`"].cast("binary"), F.lit(b""))
    total = docs.agg(F.sum(F.octet_length(docs[f"`{text_col}`"]))).first()[0] or 0
    batches, buckets = max(1, total // batch_bytes), max(8, total // bucket_bytes)
    base = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), text.alias("text"),
                       F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"))
    base = base.withColumn("tie", F.xxhash64("text")).withColumn(
        "g", F.pmod(F.xxhash64("id", "tie"), F.lit(batches)).cast("int"))

    def anchors_of(data, off, known):
        pos, h, row = find_anchors(data, off, size, anchor)
        ok = known[row]
        return pos[ok], h[ok], row[ok]

    def send(table: pa.Table) -> pa.Table:
        g = table.column("g")[0].as_py()
        _, ids, known, data, off = _ordered(table)
        _, h, row = anchors_of(data, off, known)
        by = np.lexsort((ids[row], h))
        h, d = h[by], ids[row][by]
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        end = np.concatenate([start[1:], [len(h)]]) - 1 if len(start) else start
        many = d[start] != d[end]                              # two documents of this batch already
        info = ((end - start + 1) * 2 + many).astype(np.uint32)
        h = h[start]
        b = (h % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(b, kind="stable")
        cut = np.searchsorted(b[by], np.arange(buckets + 1))
        short = (h[by] >> np.uint64(32)).astype(np.uint32)     # a filter only: equal by chance costs work, not rightness
        out = [(k, g, int(z - a), short[a:z].tobytes(), _pack(info[by[a:z]])) for k, (a, z) in enumerate(zip(cut, cut[1:])) if z > a]
        return _table(out, [("b", pa.int32()), ("g", pa.int32()), ("n", pa.int32()), ("h", pa.binary()), ("info", pa.binary())])

    def shared(table: pa.Table) -> pa.Table:
        parts = [(g, np.frombuffer(h, np.uint32), _unpack(i, np.uint32, n)) for g, n, h, i in
                 zip(*[table.column(c).to_pylist() for c in ("g", "n", "h", "info")])]
        b = table.column("b")[0].as_py()
        value, inv = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        count = np.bincount(inv)
        times = np.bincount(inv, np.concatenate([p[2] >> 1 for p in parts]))
        out = []
        for g, own, info in parts:
            at = np.searchsorted(value, own)
            hit = (count[at] > 1) | ((info & 1) > 0)
            if hit.any():
                out.append((g, b, own[hit].tobytes(), (times[at[hit]] > dense).astype(np.uint8).tobytes()))
        return _table(out, [("g2", pa.int32()), ("b", pa.int32()), ("h", pa.binary()), ("hot", pa.binary())])

    width = 10 + left_width + size
    reach = np.arange(-left_width, size)

    def records(data, off, pos, h, row):
        """Bucket by bucket: (bucket, its anchors, their distinct context records, which record each anchor has)."""
        n_left = np.minimum(pos - off[row], left_width).astype(np.uint8)
        n_right = np.minimum(off[row + 1] - pos, size).astype(np.uint8)
        b = (h % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(b, kind="stable")
        cut = np.searchsorted(b[by], np.arange(buckets + 1))
        for k, (a, z) in enumerate(zip(cut, cut[1:])):
            if z > a:
                me = by[a:z]
                rec = np.empty((len(me), width), np.uint8)
                for x in range(0, len(me), SLICE):             # places take eight times a record's bytes
                    at = me[x:x + SLICE]
                    real = (reach >= -n_left[at, None].astype(np.int64)) & (reach < n_right[at, None])
                    rec[x:x + SLICE, :8] = h[at].astype(">u8").view(np.uint8).reshape(-1, 8)
                    rec[x:x + SLICE, 8], rec[x:x + SLICE, 9] = n_left[at], n_right[at]
                    rec[x:x + SLICE, 10:] = np.where(real, data[np.clip(pos[at, None] + reach, 0, len(data) - 1)], 0)
                yield (k, me, *_distinct(rec))

    def strings(rec):
        """Every string around the anchors on its own: (place of its context, record with all else blanked)."""
        places, parts = [], []
        for o in range(left_width + 1):
            some = np.flatnonzero((rec[:, 8] >= o) & (rec[:, 9] >= size - o))
            out = np.zeros((len(some), width), np.uint8)
            out[:, :8], out[:, 8], out[:, 9] = rec[some, :8], o, size - o
            at = 10 + left_width - o
            out[:, at:at + size] = rec[some, at:at + size]
            places.append(some)
            parts.append(out)
        return np.concatenate(places), np.concatenate(parts)

    def contexts(table: pa.Table, hits: pa.Table) -> pa.Table:
        kinds = [("b", pa.int32()), ("g", pa.int32()), ("alone", pa.bool_()), ("n", pa.int32()), ("ctx", pa.binary()), ("low", pa.binary()),
                 ("more", pa.binary())]
        out = []
        if table.num_rows and hits.num_rows:
            g = table.column("g")[0].as_py()
            _, ids, known, data, off = _ordered(table)
            pos, h, row = anchors_of(data, off, known)
            want = np.concatenate([np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(b << 32) for b, x in
                                   zip(hits.column("b").to_pylist(), hits.column("h").to_pylist())])
            code = h % np.uint64(buckets) << np.uint64(32) | h >> np.uint64(32)
            hot = np.concatenate([np.frombuffer(x, np.uint8) for x in hits.column("hot").to_pylist()])
            by = np.argsort(want)
            want, hot = want[by], hot[by] > 0
            at = np.minimum(np.searchsorted(want, code), len(want) - 1)
            ok = want[at] == code
            pos, h, row, hot = pos[ok], h[ok], row[ok], hot[at[ok]]
            for k, me, rec, which in records(data, off, pos, h, row):
                low, high = _extremes(which, ids[row[me]], ids[row[me]], len(rec))
                dealt = np.zeros(len(rec), bool)
                dealt[which] = hot[me]
                calm = ~dealt
                if calm.any():
                    out.append((k, g, False, int(calm.sum()), _pack(rec[calm]), _pack(low[calm]), _pack(high[calm] - low[calm])))
                rec, low, high = rec[dealt], low[dealt], high[dealt]
                for a in range(0, len(rec), 10000):
                    some, part = strings(rec[a:a + 10000])
                    part, of = _distinct(part)
                    lo, hi = _extremes(of, low[a + some], high[a + some], len(part))
                    to = (_row_hash(part) % np.uint64(buckets)).astype(np.int64)
                    for b in np.unique(to).tolist():
                        here = to == b
                        out.append((b, g, True, int(here.sum()), _pack(part[here]), _pack(lo[here]), _pack(hi[here] - lo[here])))
        return _table(out, kinds)

    def spans_by_key(uniq, least):
        """:func:`repeat_spans` of sorted records, some anchors at a time: no group has two."""
        keys = _keys(uniq)
        out = np.empty((len(uniq), left_width + 1), np.int64)
        starts = np.unique(np.searchsorted(keys, keys[::SLICE]))
        for a, z in zip(starts, [*starts[1:], len(keys)]):
            rec = uniq[a:z]
            out[a:z] = repeat_spans(keys[a:z], left_width, rec[:, 10:], rec[:, 8].astype(np.int64), rec[:, 9].astype(np.int64), least[a:z], size)
        return out

    def decide(table: pa.Table) -> pa.Table:
        gs, alone, ns, recs, low, more = [table.column(c).to_pylist() for c in ("g", "alone", "n", "ctx", "low", "more")]
        uniq, at = _distinct(np.concatenate([_unpack(r, np.uint8, n * width).reshape(n, width) for r, n in zip(recs, ns)]))
        low, more = [np.concatenate([_unpack(x, np.int64, n) for x, n in zip(c, ns)]) for c in (low, more)]
        high = low + more
        least = np.full(len(uniq), NONE)
        np.minimum.at(least, at, low)
        smallest = spans_by_key(uniq, least)
        out, start = [], 0
        for g, one, n in zip(gs, alone, ns):
            own, last = at[start:start + n], high[start:start + n]
            start += n
            found = smallest[own, uniq[own, 8]][:, None] if one else smallest[own]
            some = (found < last[:, None]).any(axis=1)     # some document of the batch loses bytes
            if some.any():
                ctx = uniq[own]
                if not one:                                    # its anchor and which of the anchor's contexts it is
                    ctx = np.concatenate([ctx[:, :8], _rank(_keys(ctx)).astype(np.uint32)[:, None].view(np.uint8)], axis=1)
                out.append((g, one, int(some.sum()), _pack(ctx[some]), _pack(found[some].T)))
        return _table(out, [("g2", pa.int32()), ("alone", pa.bool_()), ("n", pa.int32()), ("ctx", pa.binary()), ("found", pa.binary())])

    def removed(ids, known, data, off, hits: pa.Table):
        """(row, start, end) of what goes, from the groups' smallest documents."""
        back = {False: [], True: []}
        for one, n, ctx, found in zip(*[hits.column(c).to_pylist() for c in ("alone", "n", "ctx", "found")]):
            back[one].append((_unpack(ctx, np.uint8, n * (width if one else 12)).reshape(n, -1),
                              _unpack(found, np.int64, n * (1 if one else left_width + 1)).reshape(-1, n).T))
        back = {one: [np.concatenate(x) for x in zip(*parts)] for one, parts in back.items() if parts}
        if not back:
            return
        keys = {one: _keys(c) for one, (c, _) in back.items()}
        pos, h, row = anchors_of(data, off, known)
        ok = np.isin(h, np.concatenate(list(keys.values())))
        pos, h, row = pos[ok], h[ok], row[ok]
        for k, me, rec, which in records(data, off, pos, h, row):
            small = np.full((len(rec), left_width + 1), NONE)
            own = _keys(rec)
            for one, (ctx, found) in back.items():
                mine = np.flatnonzero(keys[one] % np.uint64(buckets) == np.uint64(k))
                if not one:
                    rank = np.ascontiguousarray(ctx[mine, 8:12]).view(np.uint32).reshape(-1)
                    small[np.searchsorted(own, keys[one][mine]) + rank] = found[mine]
                    continue
                near = np.flatnonzero(np.isin(own, keys[one][mine]))
                for a in range(0, len(near), 10000):
                    some, part = strings(rec[near[a:a + 10000]])
                    uniq, of = _distinct(np.concatenate([ctx[mine], part]))
                    got = np.full(len(uniq), NONE)
                    got[of[:len(mine)]] = found[mine, 0]
                    small[near[a + some], part[:, 8]] = got[of[len(mine):]]
            for a in range(0, len(me), 1 << 16):
                x = me[a:a + (1 << 16)]
                hit = small[which[a:a + (1 << 16)]] < ids[row[x]][:, None]
                some = np.flatnonzero(hit.any(axis=1))
                if len(some):
                    at = pos[x[some]]
                    yield row[x[some]], at - (left_width - hit[some][:, ::-1].argmax(axis=1)), at + size - hit[some].argmax(axis=1)

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([base.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()),
                           T.StructField("spans", T.ArrayType(span))])

    def cut_out(table: pa.Table, hits: pa.Table) -> pa.Table:
        table, ids, known, data, off = _ordered(table)
        data = data[off[0]:off[-1]]
        off = off - off[0]
        edge = np.zeros(len(data) + 1, np.int64)
        for _, lo, hi in removed(ids, known, data, off, hits):
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi, -1)
        gone = np.cumsum(edge)[:-1] > 0
        mark = np.zeros(len(data) + 1, bool)
        mark[off] = True
        begin = np.flatnonzero(gone & (np.concatenate([[True], ~gone[:-1]]) | mark[:-1])) if len(data) else np.zeros(0, np.int64)
        stop = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]]) | mark[1:])) + 1 if len(data) else begin
        of = np.searchsorted(off, begin, side="right") - 1
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(of, np.arange(len(off))).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(begin - off[of]), pa.array(stop - off[of])], ["start", "end"]))
        before = np.concatenate([[0], np.cumsum(~gone)])           # kept bytes before each place
        rest, cuts = before[off], before[begin]
        del before
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(rest.astype(np.int64)),
                                                                                 pa.py_buffer(data[~gone])]).cast(pa.binary())
        if characters and len(cuts):
            ends = np.searchsorted(of, np.arange(len(off)))        # each row's cuts
            kept = pa.array([whole_characters(k.as_py(), (cuts[a:z] - at).tolist()) if z > a else k.as_py()
                             for k, at, a, z in zip(kept, rest, ends, ends[1:])], pa.binary())
        return pa.table([table.column("row"), pa.array(off[1:] - off[:-1]), kept, spans], ["row", "n_bytes", "kept", "spans"])

    sent = base.groupBy("g").applyInArrow(send, "b int, g int, n int, h binary, info binary")
    back = sent.groupBy("b").applyInArrow(shared, "g2 int, b int, h binary, hot binary")
    ctx = (base.groupBy("g").cogroup(back.groupBy("g2"))
           .applyInArrow(contexts, "b int, g int, alone boolean, n int, ctx binary, low binary, more binary"))
    found = ctx.groupBy("b").applyInArrow(decide, "g2 int, alone boolean, n int, ctx binary, found binary")
    return base.groupBy("g").cogroup(found.groupBy("g2")).applyInArrow(cut_out, schema)


def op2_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = remove_repeats(docs.select("doc_id", "text"), keep=["doc_id"])
    return out.select("row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
