"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts a text where its low bits are zero, so equal passages are cut alike wherever they
stand. Chunks that occur more than once in the corpus are encoded once each; the others are encoded in their document.
A chunk is encoded between its first and its last safe place (white space after other text, where these vocabularies
always split); what is left over at its ends is joined with its neighbours' ends and encoded again, over as many chunks
as it takes to reach a safe place on both sides. From there on the ids agree with those of the whole text.

Only hashes of chunks are shuffled to find the repeated ones. These go into a bitmap of fixed size, the one thing sent
to all tasks; a document without a chunk in it is encoded where it is read. Documents with one (or with a chunk that
falls on a set bit by chance, which costs work but changes nothing) have their chunks written, the distinct ones
encoded, and the ids joined back by digest, where a chunk of a third of all documents is a split side of the join. The
chunks of such documents that stand alone are moved once, to the others of their document.

Defined results: a NULL text is an empty one and has no ids; repeated rows each have their result; texts of any length
are encoded whole; columns other than the id and the text are not read, those named in ``keep`` are passed on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._bpe import DTYPE, PieceEncoder, encoder
from gaugemill.llm._rows import SIEVE_WORDS, sieve, written

MEAN_BYTES = 1024
WINDOW = 32
BATCH_ROWS = 256
SAFE = re.compile(r"(?<=\S)[ \n\t\r]")
GEAR = np.random.default_rng(20240608).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut(text: str) -> list[str]:
    """Content-defined chunks of a text; an empty text has none."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return []
    codes = np.frombuffer(data, np.uint8)
    rolled, by = GEAR[codes], 1
    while by < WINDOW:  # sum of the window's values, each shifted by its distance, by doubling
        wider = rolled.copy()
        wider[by:] += rolled[:-by] << np.uint32(by)
        rolled, by = wider, by * 2
    ends = np.flatnonzero((rolled >> np.uint32(32 - MEAN_BYTES.bit_length() + 1)) == 0) + 1
    ends = ends[ends < len(codes)]
    ends = ends[(codes[ends] & 0xC0) != 0x80]
    places = [0, *ends.tolist(), len(data)]
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(places, places[1:], strict=False)]


def chunk_hash(chunk: str) -> int:
    """Signed 64-bit hash."""
    value = xxhash.xxh3_64_intdigest(chunk.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def digest(chunk: str) -> bytes:
    return hashlib.blake2b(chunk.encode("utf-8", "surrogatepass"), digest_size=16).digest()


@dataclass(frozen=True)
class Piece:
    """An encoded chunk: text before the first safe place, ids up to the last, text after. ``ids`` None: no such place."""

    head: str
    ids: bytes | None
    tail: str


def encode_chunk(chunk: str, encode: PieceEncoder) -> Piece:
    safe = [m.start() for m in SAFE.finditer(chunk)]
    if not safe:
        return Piece(chunk, None, "")
    return Piece(chunk[: safe[0]], encode.encode(chunk[safe[0] : safe[-1]]), chunk[safe[-1] :])


def joined(pieces: list[Piece], encode: PieceEncoder) -> bytes:
    """Ids of the text that the pieces make. Ends are encoded again together, past chunks without a safe place."""
    out, open_end = [], ""
    for p in pieces:
        if p.ids is None:
            open_end += p.head
            continue
        out += [encode.encode(open_end + p.head), p.ids]
        open_end = p.tail
    return b"".join([*out, encode.encode(open_end)])


class Bitmap:
    """The repeated chunks' hashes, as one bit each in ``words`` numbers of 64 bits."""

    def __init__(self, rows: list, words: int = SIEVE_WORDS):
        self.bits = np.zeros(words, np.int64)
        self.words = words
        for r in rows:
            self.bits[r["sieve_word"]] = r["sieve_bits"]

    def has(self, value: int) -> bool:
        return bool(int(self.bits[(value >> 6) % self.words]) >> (value & 63) & 1)


def repeated_chunks(docs: DataFrame) -> Bitmap:
    """Bitmap of the chunks that occur twice or more in all texts."""

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"chunk": np.array([chunk_hash(c) for t in batch["text"] if t for c in cut(t)], np.int64)})

    counts = docs.select("text").mapInPandas(hashes, "chunk long").groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    return Bitmap(sieve(counts.where("n > 1"), "chunk").collect())  # at most SIEVE_WORDS rows


def encoded(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", most_pieces: int | None = None) -> DataFrame:
    """``ids`` (array<int>) and ``decoded`` beside ``keep``, one row per row of ``docs``.

    ``most_pieces`` bounds the pieces whose ids a worker holds (``MAX_PIECES``); it changes no result.
    """
    rows = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].alias("text"))
    kept = [f"k{i}" for i in range(len(keep))]
    types = {k: rows.schema[k].dataType.simpleString() for k in kept}
    out_schema = ", ".join([*(f"{k} {t}" for k, t in types.items()), "ids array<int>", "decoded string"])
    bitmap = repeated_chunks(rows)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, most_pieces)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            own = [i for i, t in enumerate(texts) if not any(bitmap.has(chunk_hash(c)) for c in cut(t or ""))]
            for at in range(0, len(own), BATCH_ROWS):
                part = own[at : at + BATCH_ROWS]
                yield _results(batch.select(kept).take(pa.array(part)), [encode.encode(texts[i]) for i in part], encode)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, t in enumerate(batch.column("text").to_pylist()):
                chunks = cut(t or "")
                marks = [bitmap.has(chunk_hash(c)) for c in chunks]
                if any(marks):
                    found += [(i, n, m, digest(c), c) for n, (c, m) in enumerate(zip(chunks, marks, strict=True))]
            for at in range(0, len(found), 16 * BATCH_ROWS):
                own, place, shared, key, chunk = zip(*found[at : at + 16 * BATCH_ROWS], strict=True)
                columns = [batch.column("row").take(pa.array(own))]
                firsts = pa.array([i if n == 0 else None for i, n in zip(own, place, strict=True)], pa.int64())
                columns += batch.select(kept).take(firsts).columns  # a row's other columns go with its first chunk
                values = [pa.array(place, pa.int32()), pa.array(shared), pa.array(key, pa.binary()), pa.array(chunk)]
                yield pa.record_batch([*columns, *values], names=["row", *kept, "place", "shared", "key", "chunk"])

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary, most_pieces)
        for batch in batches:
            done = [encode_chunk(c, encode) for c in batch["chunk"]]
            yield pd.DataFrame({"key": batch["key"], "head": [p.head for p in done], "ids": [p.ids for p in done], "tail": [p.tail for p in done]})

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks come by row and place; a row may go on in the next batch."""
        encode = encoder(vocabulary, most_pieces)
        row, pieces, first, ready = None, [], None, []

        def flush():
            firsts = pa.Table.from_batches([f for f, _ in ready]).combine_chunks().to_batches()[0]
            return _results(firsts, [ids for _, ids in ready], encode)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "chunk", "head", "ids", "tail", "found")]
            for i, (own, chunk, head, ids, tail, found) in enumerate(zip(*columns, strict=True)):
                if own != row:
                    if row is not None:
                        ready.append((first, joined(pieces, encode)))
                    row, pieces, first = own, [], batch.select(kept).slice(i, 1)
                    if len(ready) >= BATCH_ROWS:
                        yield flush()
                        ready = []
                pieces.append(Piece(head, ids, tail) if found else encode_chunk(chunk, encode))
        if row is not None:
            ready.append((first, joined(pieces, encode)))
            yield flush()

    own_types = ", ".join(f"{k} {t}" for k, t in types.items())
    # numbers of rows are fixed by the write
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), *kept, "text")
    chunks = written(numbered.mapInArrow(split, f"row long, {own_types}, place int, shared boolean, key binary, chunk string"), "chunks")
    once = chunks.where("shared").select("key", "chunk").dropDuplicates(["key"])
    table = written(once.mapInPandas(learn, "key binary, head string, ids binary, tail string"), "encoded-chunks").withColumn("found", F.lit(True))
    place = ["row", *kept, "place"]
    lone = chunks.where("not shared").select(*place, "chunk", F.lit(None).cast("string").alias("head"), F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("string").alias("tail"), F.lit(False).alias("found"))
    met = chunks.where("shared").select(*place, "key").join(table, "key")
    met = met.select(*place, F.lit(None).cast("string").alias("chunk"), "head", "ids", "tail", "found").unionByName(lone)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = met.repartition(n, "row").sortWithinPartitions("row", "place").mapInArrow(assemble, out_schema)
    done = rows.mapInArrow(alone, out_schema).unionByName(together)
    return done.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], "ids", "decoded")


def _results(kept: pa.RecordBatch, ids: list[bytes], encode: PieceEncoder) -> pa.RecordBatch:
    numbers = [np.frombuffer(x, DTYPE) for x in ids]
    decoded = [encode.tokenizer.decode(x.tolist(), skip_special_tokens=False) for x in numbers]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int32)
    values = np.concatenate(numbers).astype(np.int32) if numbers else np.empty(0, np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    return pa.record_batch([*kept.columns, lists, pa.array(decoded, pa.string())], names=[*kept.schema.names, "ids", "decoded"])


def encoding_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Number and digest of the ids and digest of the decoded text of every document."""
    return encoded(docs, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
