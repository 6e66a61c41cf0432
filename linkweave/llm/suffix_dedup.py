"""Exact removal of long repeated byte strings by merging front-coded sorted suffix runs.

Sampling. Not every suffix is sorted. A position is an *anchor* if the 32 bytes from it have the least
hash among all 32-byte strings of some 200-byte window. The anchor of a window depends on the window's
bytes alone, so equal windows have equal anchors at equal offsets. Every window belongs to one anchor,
and consecutive windows mostly share it: about one suffix in 85 is sorted and no repeat is lost.

Runs. A task sorts the suffixes at its anchors, each as far as its windows reach, collapses equal ones,
and front-codes the run: length of the prefix shared with the suffix before, then the rest. Runs are
exchanged by anchor hash, so suffixes with a common prefix of 32 bytes meet.

Merge. A loser tree merges the runs. Each head carries the length of its common prefix with the last
suffix given out; heads with different lengths are ordered by these alone, heads with equal lengths are
compared from there on, so no known prefix byte is compared again. The merge yields the sorted suffixes
with their common-prefix lengths.

Windows. A window that starts ``o`` bytes before its anchor is equal to another one iff the suffixes
share ``200 - o`` bytes forward and ``o`` bytes backward. Cutting the sorted order wherever the common
prefix is shorter than ``200 - o`` gives the forward classes, the same over reversed prefixes the
backward classes; windows whose pair of classes occurs twice are repeats.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import skewed_join, text_key, utf8, written


@dataclass(frozen=True)
class RepeatOptions:
    """``length``: bytes of a repeat; ``gram``: bytes that choose an anchor; ``hot``: occurrences of an
    anchor string above which its windows are dealt one by one, by digest, instead of in one task;
    ``per_task``: suffixes merged in one task; ``flush``: bytes of suffixes a task sorts at once."""

    length: int = 200
    gram: int = 32
    hot: int = 50_000
    per_task: int = 40_000
    flush: int = 48 << 20
    step: int = 2 << 20


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def anchors(texts: list[bytes], options: RepeatOptions):
    """(text number, anchor, first window, last window, hash) arrays; positions are within the text."""
    import numpy as np

    size, k = options.length, options.gram
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(texts) else np.zeros(0, np.int64)
    total = int(sizes.sum())
    none = np.zeros(0, np.int64)
    if total < size or not (sizes >= size).any():
        return none, none, none, none, none
    h = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < k:  # polynomial hash of k bytes by doubling; k is a power of two
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    reach, span = size - k + 1, 1
    while span * 2 <= reach:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < reach:
        low = np.minimum(low[: len(low) - (reach - span)], low[reach - span :])
    where = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    windows = np.maximum(sizes - size + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    first = np.concatenate(([0], np.cumsum(windows)[:-1]))
    p = np.arange(int(windows.sum())) - np.repeat(first - starts, windows)
    q = where[p]
    cut = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.concatenate((cut[1:], [len(p)])) - 1
    own = owner[cut]
    base = starts[own]
    return own, q[cut] - base, p[cut] - base, p[last] - base, h[q[cut]].view(np.int64)


def steps(texts: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """``texts`` in slices of about ``most`` bytes (a longer text alone; below 2**24 bytes it is one piece)."""
    at, held, first = 0, 0, 0
    for at, text in enumerate(texts):
        if first < at and held + len(text) > most:
            yield first, texts[first:at]
            first, held = at, 0
        held += len(text)
    if first < len(texts):
        yield first, texts[first:]


def text_anchors(texts: list[bytes], options: RepeatOptions):
    """``anchors`` for texts of any length: those beyond 15 MB go in overlapping pieces."""
    import numpy as np

    piece = 15_000_000
    parts = []
    for first, some in steps(texts, options.step):
        if len(some) == 1 and len(some[0]) > piece:
            text = some[0]
            for at in range(0, len(text), piece - options.length + 1):
                _, q, lo, hi, h = anchors([text[at : at + piece]], options)
                parts.append((np.full(len(q), first), q + at, lo + at, hi + at, h))
        else:
            own, q, lo, hi, h = anchors(some, options)
            parts.append((own + first, q, lo, hi, h))
    if not parts:
        return (np.zeros(0, np.int64),) * 5
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are equal and not looked at."""
    n = min(len(a), len(b))
    if n <= known:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


class RunBuilder:
    """Suffixes of one task by partition; equal ones are collapsed into one with a count."""

    def __init__(self) -> None:
        self.parts: dict[int, dict[tuple[bytes, bytes, int], list]] = {}
        self.bytes = 0

    def add(self, part: int, ahead: bytes, back: bytes, skip: int, key: str, at: int) -> None:
        """``ahead``: the suffix; ``back``: the reversed bytes before it; ``skip``: least window offset."""
        members = self.parts.setdefault(part, {}).setdefault((ahead, back, skip), [])
        if not members:
            self.bytes += len(ahead) + len(back) + 200
        self.bytes += 40
        members.append((key, at))

    def runs(self) -> Iterator[tuple[int, bytes]]:
        """(partition, sorted front-coded run)."""
        for part, found in self.parts.items():
            order = sorted(found)
            before, shared, rest = b"", [], []
            for ahead, _, _ in order:
                n = common_prefix(before, ahead)
                shared.append(n)
                rest.append(ahead[n:])
                before = ahead
            yield part, pickle.dumps((shared, rest, [x[1] for x in order], [x[2] for x in order], [found[x] for x in order]), 5)
        self.parts, self.bytes = {}, 0


class LoserTree:
    """Merges sorted runs of (string, prefix shared with the one before, payload).

    ``known[r]`` is the length of the prefix that run ``r``'s head shares with the last string given
    out. A node keeps the loser of its match; a match looks at bytes only if both sides know equally much.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.k = 1
        while self.k < max(1, len(runs)):
            self.k *= 2
        self.heads: list = [next(r, None) for r in runs] + [None] * (self.k - len(runs))
        self.known = [0] * self.k
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        winner, loser = self._match(self._play(2 * node), self._play(2 * node + 1))
        self.losers[node] = loser
        return winner

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; sets what the loser knows about the winner."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        na, nb = self.known[a], self.known[b]
        if na != nb:
            return (a, b) if na > nb else (b, a)
        s, t = x[0], y[0]
        n = common_prefix(s, t, na)
        if n == len(s) or n < len(t) and s[n] < t[n]:
            self.known[b] = n
            return a, b
        self.known[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[int, object]]:
        """(prefix shared with the string before, head) in sorted order."""
        heads, known, losers, k = self.heads, self.known, self.losers, self.k
        while (head := heads[self.winner]) is not None:
            w = self.winner
            yield known[w], head
            heads[w] = after = next(self.runs[w], None)
            known[w] = after[1] if after else 0
            node = (w + k) // 2
            while node:
                winner, losers[node] = self._match(w, losers[node])
                w = winner
                node //= 2
            self.winner = w


def decoded(run: bytes) -> Iterator[tuple[bytes, int, tuple]]:
    """(suffix, prefix shared with the one before, payload) of a front-coded run."""
    shared, rest, backs, skips, members = pickle.loads(run)
    before = b""
    for n, tail, back, skip, who in zip(shared, rest, backs, skips, members, strict=True):
        before = before[:n] + tail
        yield before, n, (back, skip, who)


def repeated_windows(merged: list[tuple[int, tuple]], options: RepeatOptions):
    """Boolean table: is the window at offset ``o`` (column) before suffix ``i`` (row) a repeat?"""
    import numpy as np

    n, size = len(merged), options.length
    offsets = size - options.gram + 1
    ahead = np.array([x[0] for x in merged], np.int64)
    backs = [x[1][2][0] for x in merged]
    skip = np.array([x[1][2][1] for x in merged], np.int64)
    weight = np.array([len(x[1][2][2]) for x in merged], np.int64)
    reach = np.array([len(b) for b in backs], np.int64)
    order = sorted(range(n), key=backs.__getitem__)
    behind = np.zeros(n, np.int64)
    for i in range(1, n):
        behind[i] = common_prefix(backs[order[i - 1]], backs[order[i]])
    order = np.array(order, np.int64)
    out = np.zeros((n, offsets), bool)
    back_class = np.empty(n, np.int64)
    for o in range(offsets):
        ok = np.flatnonzero((skip <= o) & (reach >= o))
        if not len(ok):
            continue
        back_class[order] = np.cumsum(behind < o) if o else 0
        pair = (np.cumsum(ahead < size - o) * (n + 1) + back_class)[ok]
        by = np.argsort(pair, kind="stable")
        ranked = pair[by]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        counts = np.add.reduceat(weight[ok][by], first)
        out[ok[by], o] = np.repeat(counts, np.diff(np.concatenate((first, [len(by)])))) > 1
    return out


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with overlapping and touching ones joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def merge_runs(runs: list[bytes], options: RepeatOptions) -> dict[str, list[tuple[int, int]]]:
    """Repeated byte spans by text key, from all runs of one partition."""
    import numpy as np

    merged = list(LoserTree([decoded(r) for r in runs]))
    found: dict[str, list[tuple[int, int]]] = {}
    if not merged:
        return found
    hit = repeated_windows(merged, options)
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    for i, a, b in zip(row.tolist(), start.tolist(), stop.tolist(), strict=True):
        for key, q in merged[i][1][2][2]:
            found.setdefault(key, []).append((q - b + 1, q - a + options.length))
    return {k: joined_spans(v) for k, v in found.items()}


def repeat_spans(docs: DataFrame, options: RepeatOptions = RepeatOptions()) -> DataFrame:
    """(text_key, spans) of every text with repeated bytes; ``spans`` are arrays of packed int32 pairs.

    Equal texts meet as one representative. Texts that stand in several rows are not listed for that
    alone (see ``remove_repeats``), but they are partners for all others.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_key(F.col("text")))
    thin = docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t64"))

    def chosen(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = utf8(batch, "text")
            own, _, _, _, h = text_anchors(texts, options)
            pairs = np.stack([own, h], 1)
            pairs, times = np.unique(pairs, axis=0, return_counts=True) if len(own) else (pairs, own)
            names = np.asarray(batch.column(batch.schema.get_field_index("t64")).to_numpy(zero_copy_only=False))
            arrays = [pa.array(names[pairs[:, 0]], pa.int64()), pa.array(pairs[:, 1], pa.int64()), pa.array(np.minimum(times, 2), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["t64", "h", "times"])

    cells = written(thin.mapInArrow(chosen, "t64 long, h long, times int"))
    # an anchor string that stands once in the whole corpus can't be part of a repeat
    twice = (
        cells.groupBy("h")
        .agg(F.min("t64").alias("a"), F.max("t64").alias("b"), F.max("times").alias("t"), F.count(F.lit(1)).alias("n"))
        .filter("a <> b or t > 1")
        .select("h", "n")
    )
    twice = written(twice)
    total = twice.agg(F.sum(F.least("n", F.lit(options.hot)))).first()[0] or 0
    parts = max(1, -(-total // options.per_task))
    wanted = cells.join(twice, "h").groupBy("t64").agg(
        F.collect_set(F.when(F.col("n") <= options.hot, F.col("h"))).alias("usual"),
        F.collect_set(F.when(F.col("n") > options.hot, F.col("h"))).alias("hot"),
    )
    texts = keyed.select("doc_id", "text_key", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t64"))
    texts = texts.groupBy("text_key", "t64").agg(F.min("doc_id").alias("least_id"))
    picked = texts.join(wanted, "t64").select(F.col("text_key").alias("k"), "least_id", "usual", "hot")
    one = keyed.join(picked, (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("least_id")))

    def runs(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int32(), pa.int32())
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["part", "run", "digest", "text_key", "at", "times"])

        builder = RunBuilder()
        for batch in batches:
            texts = utf8(batch, "text")
            names = batch.column(batch.schema.get_field_index("text_key")).to_pylist()
            usual = batch.column(batch.schema.get_field_index("usual"))
            hot = batch.column(batch.schema.get_field_index("hot"))
            own, at, first, last, h = text_anchors(texts, options)
            bounds = np.searchsorted(own, np.arange(len(texts) + 1))
            windows: dict[bytes, list] = {}
            for i, text in enumerate(texts):
                some = slice(bounds[i], bounds[i + 1])
                hashes = h[some]
                known = np.isin(hashes, np.asarray(usual[i].values))
                for x in np.flatnonzero(known).tolist():
                    q, lo, hi, v = int(at[some][x]), int(first[some][x]), int(last[some][x]), int(hashes[x])
                    builder.add(v % parts, text[q : hi + options.length], text[lo:q][::-1], q - hi, names[i], q)
                if len(hot[i].values):
                    for x in np.flatnonzero(np.isin(hashes, np.asarray(hot[i].values))).tolist():
                        for p in range(int(first[some][x]), int(last[some][x]) + 1):
                            digest = hashlib.blake2b(text[p : p + options.length], digest_size=16).digest()
                            windows.setdefault(digest, []).append((names[i], p))
                if builder.bytes > options.flush:
                    yield packed([(part, run, None, None, None, None) for part, run in builder.runs()])
            if windows:
                yield packed([(None, None, d, k, p, len(w)) for d, w in windows.items() for k, p in w])
        yield packed([(part, run, None, None, None, None) for part, run in builder.runs()])

    made = one.select("doc_id", "text", "text_key", "usual", "hot").mapInArrow(
        runs, "part long, run binary, digest binary, text_key string, at int, times int"
    )

    def merged(table):
        import numpy as np
        import pyarrow as pa

        found = merge_runs(table.column("run").to_pylist(), options)
        return pa.table(
            {
                "text_key": pa.array(list(found), pa.string()),
                "spans": pa.array([np.array(v, np.int32).tobytes() for v in found.values()], pa.binary()),
            }
        )

    if not twice.filter(F.col("n") > options.hot).isEmpty():
        made = written(made)
        rows = made.filter("digest is not null")
        counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
        hits = rows.join(counts, "digest").select("text_key", "at").groupBy("text_key").agg(F.sort_array(F.collect_set("at")).alias("ats"))
        many = hits.mapInArrow(_window_spans(options.length), "text_key string, spans binary")
    else:
        many = None
    spans = made.filter("run is not null").select("part", "run").groupBy("part").applyInArrow(merged, "text_key string, spans binary")
    if many is not None:
        spans = spans.unionByName(many)
    return written(spans).groupBy("text_key").agg(F.collect_list("spans").alias("spans"))


def _window_spans(length: int):
    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            spans = [np.array(joined_spans([(p, p + length) for p in ats]), np.int32).tobytes() for ats in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.binary())], names=["text_key", "spans"])

    return scan


def remove_repeats(docs: DataFrame, options: RepeatOptions = RepeatOptions(), with_text: bool = False) -> DataFrame:
    """Every row of ``docs`` without the bytes covered by a repeated string of ``length`` bytes.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes, if asked for).
    Null text is empty. Texts below ``length`` bytes keep all. Rows of equal text remove all of each
    other; so do repeated rows. Matches never cross rows; further columns are ignored.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_key(F.col("text")))
    copies = keyed.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    spans = repeat_spans(docs, options)
    found = spans.join(copies, "text_key", "full")
    rows = skewed_join(keyed, written(found), "text_key", "left").select("doc_id", "text", "spans", "copies")

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            parts, copied = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("spans", "copies"))
            for text, packs, times in zip(utf8(batch, "text"), parts, copied, strict=True):
                if times and len(text) >= options.length:
                    spans = [(0, len(text))]
                elif packs:
                    spans = joined_spans([tuple(x) for p in packs for x in np.frombuffer(p, np.int32).reshape(-1, 2).tolist()])
                else:
                    spans = []
                out, at = [], 0
                for a, b in spans:
                    out.append(text[at:a])
                    at = b
                kept = b"".join([*out, text[at:]])
                row = (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_text else None)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_text]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_text]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False))], names=names)

    return rows.mapInArrow(cut, SCHEMA + ", kept binary" * with_text)
