"""N-gram Jaccard self-join: MinHash banding finds candidates, full n-gram sets verify them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, skewed_join, text_key, utf8, written
from .components import components


@dataclass(frozen=True)
class JoinOptions:
    """``words`` per n-gram; pairs of ``similarity`` or more are links; ``recall`` is the least chance that
    a pair at the threshold shares a band; ``rows`` per band None: the most that needs at most
    ``max_bands`` bands; ``block``: texts that one task compares at once; ``doubt``: standard deviations by
    which a pair's sketches may fall short of the threshold before the pair is no candidate any more."""

    words: int = 5
    similarity: float = 0.8
    recall: float = 0.9995
    max_bands: int = 24
    rows: int | None = None
    block: int = 512
    doubt: float = 5.0
    seed: int = 20250101


def banding(options: JoinOptions) -> tuple[int, int]:
    """(bands, rows): the widest bands whose number for the recall stays within ``max_bands``."""
    best = None
    for rows in [options.rows] if options.rows else range(1, 17):
        miss = 1 - options.similarity**rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - options.recall) / math.log(miss))
        if best is None or bands <= options.max_bands:
            best = (max(1, bands), rows)
    return best


_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def shingles(text: bytes, n: int):
    """Sorted distinct 64-bit hashes of the word n-grams; a text of fewer words is one n-gram."""
    import numpy as np
    import xxhash

    words = text.translate(_FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    code: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    for w in set(words):
        code[w] = digest(w)
    ids = np.array([code[w] for w in words], np.uint64)
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, len(words) if k < n else n, np.uint64)
    for i in range(k):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ ids[i : len(words) - k + 1 + i]
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


class Bands:
    """Band hashes of an n-gram set, from the minima of ``bands * rows`` multiply-shift hashes, and the sketch: a byte of each minimum."""

    def __init__(self, options: JoinOptions):
        import numpy as np

        self.bands, self.rows = banding(options)
        rng = np.random.default_rng(options.seed)
        n = self.bands * self.rows
        self.a = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64)

    def __call__(self, grams):
        """(int64 array of ``bands`` hashes, uint8 array of ``bands * rows`` values)."""
        import numpy as np

        low = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(grams), 1024):
            part = grams[at : at + 1024]
            mixed = (part[None, :] * self.a[:, None] + self.b[:, None]) >> np.uint64(32)
            np.minimum(low, mixed.min(1).astype(np.uint32), out=low)
        rows = low.reshape(self.bands, self.rows).astype(np.uint64)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for i in range(self.rows):
            out = (out ^ rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return out.view(np.int64), low.astype(np.uint8)


def likely(sketches, options: JoinOptions):
    """Pairs (i, j) of rows of ``sketches`` whose similarity may reach the threshold.

    The share of equal bytes estimates the similarity; a pair at the threshold falls short by ``doubt``
    standard deviations less than once in a million times.
    """
    import numpy as np

    n = sketches.shape[1]
    s = options.similarity
    least = n * (s - options.doubt * (s * (1 - s) / n) ** 0.5)
    found = []
    for i in range(len(sketches) - 1):
        j = np.flatnonzero((sketches[i + 1 :] == sketches[i]).sum(1) >= least)
        found.append(np.stack([np.full(len(j), i), j + i + 1], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def linked(left: list, right: list | None, left_bands, right_bands, similarity: float):
    """Pairs (i, j) of sets with Jaccard of ``similarity`` or more among those that share a band.

    Intersections are counted exactly from the full sets by a product of 0/1 matrices over the n-grams
    that occur in at least two of the sets. With ``right`` None, pairs within ``left`` (i < j).
    """
    import numpy as np

    sets = left + (right or [])
    m, k = len(left), len(right or [])
    if len(sets) < 2 or right is not None and not (m and k):
        return np.zeros((0, 2), np.int64)
    other_bands = left_bands if right is None else right_bands
    share = np.zeros((m, len(other_bands)), bool)
    for band in range(left_bands.shape[1]):
        share |= left_bands[:, band][:, None] == other_bands[:, band][None, :]
    size = np.array([len(s) for s in sets], np.float64)
    big = size[:m][:, None]
    small = (size[:m] if right is None else size[m:])[None, :]
    share &= np.minimum(big, small) >= similarity * np.maximum(big, small)
    if right is None:
        share &= np.triu(np.ones_like(share), 1)
    i, j = np.nonzero(share)
    if not len(i):
        return np.zeros((0, 2), np.int64)
    if len(i) <= 4 * len(sets):
        offset = 0 if right is None else m
        inter = np.array([len(np.intersect1d(sets[a], sets[b + offset], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    else:
        owner = np.repeat(np.arange(len(sets)), size.astype(np.int64))
        grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = times[column] > 1
        place = np.cumsum(times > 1) - 1
        owner, column, width = owner[keep], place[column[keep]], int((times > 1).sum())
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        table = np.zeros((m, len(other_bands)), np.float32)
        for at in range(0, width, 4096):
            lo, hi = np.searchsorted(column, [at, at + 4096])
            dense = np.zeros((len(sets), min(4096, width - at)), np.float32)
            dense[owner[lo:hi], column[lo:hi] - at] = 1
            table += dense[:m] @ (dense[:m] if right is None else dense[m:]).T
        inter = table[i, j].astype(np.float64)
    union = big[i, 0] + small[0, j] - inter
    ok = inter >= similarity * union - 1e-9
    return np.stack([i[ok], j[ok]], 1)


def stars(n: int, pairs) -> list[tuple[int, int]]:
    """(member, root) edges that connect what ``pairs`` connect: at most n - 1 of them."""
    root = list(range(n))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(i, find(i)) for i in range(n) if find(i) != i]


def near_duplicates(docs: DataFrame, options: JoinOptions = JoinOptions()) -> DataFrame:
    """Every row of ``docs`` with its class and links: doc_id, text_key, class_id, n_links, n_copies.

    ``class_id`` is the least doc_id of the connected class over links and equal texts (null if all its
    ids are null); ``n_links`` counts the *different* texts linked to the row's text, ``n_copies`` the
    rows of equal text. Texts without words (null, empty) only join their own copies. A text of fewer
    than ``words`` words is one n-gram. Equal texts meet once, as one representative.

    Candidates: texts that share a band hash meet in a cell. Cells of the same texts count once. In a cell
    of up to ``block`` texts, pairs that their sketches rule out are no candidates, so chance hits don't
    chain; a larger cell is taken whole. Connected candidates are verified on their full n-gram sets: up to
    ``block`` texts in one task; more are cut into blocks by hash and each pair of blocks is compared in a
    task of its own, so no task holds more than two blocks. Compared pairs stay inside the task; only link
    counts and spanning edges leave it.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = narrow.withColumn("text_key", text_key(F.col("text")))
    bands, _ = banding(options)

    def signed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        band = Bands(options)
        for batch in batches:
            made = [band(g) if len(g := shingles(t, options.words)) else None for t in utf8(batch, "text")]
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text_key")]
            signs = [pa.array([m and m[i].tobytes() for m in made], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*rest, *signs], names=["doc_id", "text_key", "sig", "sketch"])

    rows = written(keyed.mapInArrow(signed, "doc_id long, text_key string, sig binary, sketch binary"))
    texts = rows.groupBy("text_key").agg(F.max("sig").alias("sig"), F.max("sketch").alias("sketch"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_copies"))
    texts = written(texts)

    signatures = texts.filter("sig is not null").select("text_key", "sig", "sketch")
    cells = signatures.select(
        "text_key",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.hex(F.substring("sig", i * 8 + 1, F.lit(8))))).alias("band", "h"),
    ).select("text_key", F.xxhash64("band", "h").alias("cell"))
    shared = cells.groupBy("cell").agg(
        F.min("text_key").alias("v"), F.max("text_key").alias("w"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("text_key")).alias("all")
    )
    # cells of the same texts are one
    shared = written(shared.filter("n > 1").groupBy("v", "w", "n", "all").agg(F.min("cell").alias("cell")).select("cell", "v", "n"))
    held = skewed_join(cells, shared, "cell")
    met = written(held.select("cell", "v", "n", "text_key"))
    small = met.filter(F.col("n") <= options.block)
    tasks = max(1, small.count() // 20_000)

    def narrowed(table):
        import numpy as np
        import pyarrow as pa

        order = np.argsort(table.column("cell").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        names = table.column("text_key").to_pylist()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(names), -1)
        cell = table.column("cell").to_numpy()
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        edges = set()
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(names)], strict=True):
            for i, j in stars(b - a, likely(sketches[a:b], options)):
                edges.add((names[a + i], names[a + j]))
        made = sorted(edges)
        return pa.table({"u": pa.array([x for x, _ in made], pa.string()), "v": pa.array([y for _, y in made], pa.string())})

    dealt_cells = small.join(signatures.select("text_key", "sketch").hint("merge"), "text_key").select("cell", "text_key", "sketch")
    likely_edges = dealt_cells.groupBy(F.pmod(F.xxhash64("cell"), F.lit(tasks)).alias("t")).applyInArrow(narrowed, "u string, v string")
    large = met.filter(F.col("n") > options.block).select(F.col("text_key").alias("u"), "v")
    candidate = written(components(likely_edges.union(large)).withColumnRenamed("node", "text_key"))
    forget(met, shared)
    sizes = written(candidate.groupBy("component").agg(F.count(F.lit(1)).alias("members")))
    blocks = F.ceil(F.col("members") / options.block).cast("int")
    dealt = (
        skewed_join(candidate, sizes, "component")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "text_key"), F.col("blocks")).cast("int"))
        .join(texts.select("text_key", "sig", "least_id").hint("merge"), "text_key")
        .withColumnRenamed("text_key", "k")
    )

    def grams(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = [shingles(t, options.words).tobytes() for t in utf8(batch, "text")]
            keep = ["text_key", "component", "blocks", "block", "sig"]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(made, pa.binary())], names=[*keep, "grams"])

    # one row of each candidate text: the copy with the least doc_id (or any, where ids repeat or are null);
    # joined on text and id, so the copies of a text don't meet
    one = keyed.join(dealt.hint("merge"), (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("least_id")))
    sets = one.select("text_key", "component", "blocks", "block", "sig", "text").mapInArrow(
        grams, "text_key string, component string, blocks int, block int, sig binary, grams binary"
    )
    # a text of block b meets block pairs (b, c) and (c, b) for every c: tasks (low, high)
    paired = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "text_key", "sig", "grams"
    )

    def compare(key, table):
        import numpy as np
        import pyarrow as pa

        _, low, high = (k.as_py() for k in key)
        seen: dict[str, tuple] = {}
        names, owners = table.column("text_key").to_pylist(), table.column("block").to_pylist()
        for name, block, sig, gram in zip(names, owners, table.column("sig").to_pylist(), table.column("grams").to_pylist(), strict=True):
            seen.setdefault(name, (block, np.frombuffer(sig, np.int64), np.frombuffer(gram, np.uint64)))
        first = sorted(n for n, x in seen.items() if x[0] == low)
        second = sorted(n for n, x in seen.items() if x[0] == high) if high != low else []
        ids = first + second
        get = lambda some, i: [seen[n][i] for n in some]
        if high == low:
            found = linked(get(first, 2), None, np.stack(get(first, 1)), None, options.similarity) if first else np.zeros((0, 2), int)
        elif first and second:
            found = linked(get(first, 2), get(second, 2), np.stack(get(first, 1)), np.stack(get(second, 1)), options.similarity)
            found = found + np.array([0, len(first)])
        else:
            found = np.zeros((0, 2), int)
        counts = np.bincount(found.ravel(), minlength=len(ids)) if len(found) else np.zeros(len(ids), np.int64)
        roots = dict(stars(len(ids), found))
        hit = [i for i in range(len(ids)) if counts[i]]
        return pa.table(
            {
                "text_key": pa.array([ids[i] for i in hit], pa.string()),
                "root": pa.array([ids[roots.get(i, i)] for i in hit], pa.string()),
                "links": pa.array([int(counts[i]) for i in hit], pa.int64()),
            }
        )

    links = written(paired.groupBy("component", "low", "high").applyInArrow(compare, "text_key string, root string, links long"))
    counted = links.groupBy("text_key").agg(F.sum("links").alias("n_links"))
    classes = components(links.select(F.col("text_key").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "text_key")
    member = written(
        texts.select("text_key", "least_id", "n_copies")
        .join(classes.hint("merge"), "text_key", "left")
        .join(counted.hint("merge"), "text_key", "left")
        .withColumn("component", F.coalesce("component", "text_key"))
    )
    heads = written(member.groupBy("component").agg(F.min("least_id").alias("class_id")))
    named = skewed_join(member, heads, "component").select("text_key", "component", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    named = written(named)
    forget(links, candidate, member, sizes, heads)
    return skewed_join(rows.select("doc_id", "text_key"), named, "text_key")


def keep_one(docs: DataFrame, options: JoinOptions = JoinOptions()) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the least (doc_id, text); same columns, whatever their names.

    Rows with a null doc_id come last in that order. Of rows equal in id and text, the one whose JSON form
    has the least digest stays. Null texts and empty ones are one class; an empty table gives no rows.
    """
    found = written(near_duplicates(docs, options))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = found.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    kept = kept.groupBy("component").agg(F.min(F.struct(row.alias("row"), "n")).alias("k"))
    kept = kept.select(F.col("k.row.doc_id").alias("id"), F.col("k.row.text_key").alias("k"), "k.n")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(whole.alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"))
    joined = packed.join(kept.hint("merge"), (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id")))
    single = joined.filter("n = 1").select("whole.*")
    again = joined.filter("n > 1").groupBy("text_key", "doc_id").agg(F.min_by("whole", F.md5(F.to_json("whole").cast("binary"))).alias("whole"))
    return single.union(again.select("whole.*"))
