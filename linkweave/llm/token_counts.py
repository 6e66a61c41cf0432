"""Token counts from pre-token frequencies: pieces are counted once per distinct pre-token of the corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import skewed_join, utf8, written

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

#: The pre-token pattern of byte-level BPE (fixed value; the vocabulary was built with it).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pre-tokens that make up one in ``HEAD`` of all occurrences or more, of ``HEAD_BYTES`` UTF-8 bytes at most, are broadcast.
#: There are at most ``HEAD`` such, whatever the corpus.
HEAD = 1_000_000
HEAD_BYTES = 48


class PreTokens:
    """Cuts texts into pre-tokens as the tokenizer of a byte-level BPE file does; a special string is one token."""

    def __init__(self, path: str):
        import json

        import regex

        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        pre = form.get("pre_tokenizer") or {}
        added = form.get("added_tokens", [])
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        odd = any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip"))
        if form.get("normalizer") or form.get("post_processor") or pre != pre | plain or odd:
            raise ValueError("pre-token counts need a plain byte-level BPE file")
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PATTERN).findall

    def __call__(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, number of special strings)."""
        if self.special is None or not self.special.search(text):
            return self.split(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in self.split(part)], len(parts) - 1


def _digest():
    import xxhash

    return lambda word: xxhash.xxh3_128_digest(word.encode())


def pre_token_counts(docs: DataFrame, tokenizer: str, most: int = 200_000) -> DataFrame:
    """(word, n): every distinct pre-token of the corpus and how often it stands there. A task adds up its
    own first; one that holds more than ``most`` sends them on and starts anew."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cut, counts = PreTokens(tokenizer), Counter()

        def out() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        for batch in batches:
            for text in utf8(batch, "text"):
                counts.update(cut(text.decode("utf-8", "replace"))[0])
                if len(counts) > most:
                    yield out()
                    counts.clear()
        yield out()

    return docs.select("text").mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pieces(words: DataFrame, tokenizer: str) -> DataFrame:
    """``words`` (word, n) with the digest of the word and its number of pieces: each is encoded once in all."""

    def scan(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, digest = Tokenizer.from_file(tokenizer).encode_batch, _digest()
        for batch in batches:
            some = batch.column(batch.schema.get_field_index("word")).to_pylist()
            found = [len(e) for e in encode(some, add_special_tokens=False)]
            arrays = [*batch.columns, pa.array(map(digest, some), pa.binary()), pa.array(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "n", "digest", "pieces"])

    return words.select("word", "n").mapInArrow(scan, "word string, n long, digest binary, pieces int")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every row of ``docs``; ``tokenizer`` is the path of a byte-level BPE file.

    Null text is empty: 0 bytes, 0 tokens. Repeated rows and null ids are rows of their own, further columns
    are ignored, an empty table gives no rows.

    First the distinct pre-tokens of the corpus are counted and each is cut into pieces once. Then they are
    joined to the pre-token frequencies of the documents. The most frequent ones, bounded in number and
    bytes and so broadcast, meet the frequencies where these are made, and leave one sum per document; the
    rest of a document's frequencies are exchanged by pre-token and summed. With them goes one row per document
    that no pre-token meets, so one pass over the texts gives both. Token ids exist only inside ``pieces``.
    """
    spark = docs.sparkSession
    words = written(pieces(pre_token_counts(docs, tokenizer), tokenizer))
    whole = words.agg(F.sum("n")).first()[0] or 0
    often = words.filter((F.octet_length("word") <= HEAD_BYTES) & (F.col("n") * HEAD >= whole))
    head = spark.sparkContext.broadcast({r[0]: r[1] for r in often.select("word", "pieces").collect()})

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        cut, known, digest = PreTokens(tokenizer), head.value, _digest()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            raw = utf8(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            first, digests, times, owners, sums = row, [], [], [], []
            for text in raw:
                found, total = cut(text.decode("utf-8", "replace"))
                rare = 0
                for word, n in Counter(found).items():
                    if (size := known.get(word)) is not None:
                        total += size * n
                    else:
                        digests.append(digest(word))
                        times.append(n)
                        rare += 1
                sums.append(total)
                owners.append(rare)
                row += 1
            # one row per document under a digest of its own
            n, rows = len(digests), np.arange(first, row)
            digests += [digest(f"\0{r}") + b"." for r in rows.tolist()]
            nothing = pa.nulls(n, pa.int64())
            columns = [
                pa.array(np.concatenate((np.repeat(rows, owners), rows))), pa.array(digests, pa.binary()), pa.array(times + [0] * len(raw), pa.int32()),
                pa.concat_arrays([nothing, ids]), pa.concat_arrays([nothing, pa.array(map(len, raw), pa.int64())]), pa.concat_arrays([nothing, pa.array(sums, pa.int64())]),
            ]
            made = pa.RecordBatch.from_arrays(columns, names=["row", "digest", "times", "doc_id", "n_bytes", "common"])
            for at in range(0, len(made), 100_000):
                yield made.slice(at, 100_000)

    made = docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        scan, "row long, digest binary, times int, doc_id long, n_bytes long, common long"
    )
    met = skewed_join(made, words.select("digest", "pieces"), "digest", "left")
    rest = F.coalesce(F.sum(F.col("pieces") * F.col("times")), F.lit(0))
    done = met.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), (F.max("common") + rest).alias("n_tokens"))
    return done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
