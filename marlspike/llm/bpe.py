"""Byte-level BPE encoding and decoding by a rank file.

Texts over ``CHUNK`` characters are cut into chunks that overlap by ``OVERLAP``. All
chunks are pre-tokenised in parallel; where a chunk and its predecessor both begin a
pre-token at the same place of the overlap, they agree from there on, so the text is
cut at the first such place. The pieces are encoded in parallel and their ids put
together in order. A text with an overlap that does not resynchronise is encoded whole.
Shorter texts are one piece. Decoding concatenates the bytes of the tokens.

A null text is empty and has no ids. Repeated rows are encoded as often as they stand.
Ids are columns of little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from marlspike.llm import bytetext as B
from marlspike.llm.scratch import stored
from marlspike.llm.tokens import Cache, packed, read_ranks

CHUNK, OVERLAP = 1 << 15, 1 << 9
#: White space beside a blank, where a blank may not begin a pre-token.
_UNSAFE = re.compile(rb"[\x00-\x20] | [\x00-\x20]|^ | $|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SAFE = re.compile(rb"(?<=[\x21-\x7e]) (?=[\x21-\x7e])")


class RankTokens:
    """Encoder and decoder of one worker process."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(path)
        self.own = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.after_blank, self.at_start = Cache(self._blank), Cache(self._plain)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.token[i] = token

    def _plain(self, part: bytes) -> bytes:
        return packed(self.own.encode_ordinary(part.decode()))

    def _blank(self, part: bytes) -> bytes:
        if part.isalpha():
            return packed(self.own._encode_single_piece(b" " + part))
        if part[:-1].isalpha() and 0x20 < part[-1] < 0x7F and not part[-1:].isalnum():
            return self.after_blank[part[:-1]] + self.at_start[part[-1:]]
        return self._plain(b" " + part)

    def ids(self, text: bytes) -> bytes:
        """A blank between two visible characters begins a pre-token whatever stands around them."""
        if not text:
            return b""
        if _UNSAFE.search(text) is None:
            parts = text.split(b" ")
            return self.at_start[parts[0]] + b"".join(map(self.after_blank.__getitem__, parts[1:]))
        cuts = [0, *(m.start() for m in _SAFE.finditer(text)), len(text)]
        return b"".join([self.at_start[text[a:b]] for a, b in zip(cuts, cuts[1:])])

    def text(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, array("I", ids)))


_codecs: dict[tuple[str, str], RankTokens] = {}


def codec(path: str, pattern: str) -> RankTokens:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = RankTokens(path, pattern)
    return _codecs[path, pattern]


def _encode_rows(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """The last column, a text, becomes ``ids``."""
    fields = rows.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for first, last, data, offsets in B.slices(batch.column(len(fields))):
                raw = data.tobytes()
                ids = [own.ids(raw[a:b]) for a, b in zip(offsets, offsets[1:])]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], [*(f.name for f in fields), "ids"])

    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.BinaryType())]))


def _marks(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Per chunk: where pre-tokens begin in the overlaps at its start and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).finditer
        for batch in batches:
            head, tail = [], []
            for k, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                starts = [m.start() for m in find(text)]
                head.append([k * chunk + s for s in starts if 0 < s < overlap])
                tail.append([k * chunk + s for s in starts if chunk < s < chunk + overlap])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))],
                ["rid", "chunk", "head", "tail"])

    return chunks.select("rid", "chunk", "part").mapInArrow(run, "rid long, chunk long, head array<bigint>, tail array<bigint>")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with ``ids``."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text]).alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    is_long = F.length("text") > chunk + overlap
    short = _encode_rows(rows.filter(~is_long), path, pattern)

    n_chunks = F.ceil((F.length("text") - overlap) / F.lit(chunk)).cast("long")
    long = stored(rows.filter(is_long).withColumn("rid", F.monotonically_increasing_id()), "long")
    chunks = long.select("rid", n_chunks.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("chunk"), "text").select(
        "rid", "n", "chunk", F.substring("text", (F.col("chunk") * chunk + 1).cast("int"), F.lit(chunk + overlap)).alias("part"))
    chunks = stored(chunks.repartition(F.xxhash64("rid", "chunk")), "chunks")
    marks = _marks(chunks, pattern, chunk, overlap)
    before = marks.select("rid", (F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("before"))
    cuts = marks.join(before, ["rid", "chunk"], "left").select(
        "rid", "chunk", F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(F.array_min(F.array_intersect("before", "head"))).alias("cut"))
    cuts = stored(cuts, "cuts")
    broken = cuts.filter(F.col("cut").isNull()).select("rid").distinct()
    ends = cuts.select("rid", (F.col("chunk") - 1).alias("chunk"), F.col("cut").alias("end"))
    pieces = (chunks.join(cuts, ["rid", "chunk"]).join(ends, ["rid", "chunk"], "left").join(broken, "rid", "left_anti").select(
        "rid", "chunk", F.expr(f"substring(part, int(cut - chunk * {chunk}) + 1, int(coalesce(end, cut + {chunk + overlap}) - cut))").alias("piece")))
    whole = long.join(broken, "rid", "left_semi").select("rid", F.lit(0).cast("long").alias("chunk"), F.col("text").alias("piece"))
    encoded = _encode_rows(pieces.unionByName(whole), path, pattern)
    # one row per long text: as large as the text itself
    joined = encoded.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts")).select(
        "rid", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    return short.unionByName(long.select("rid", "row").join(joined, "rid").select("row", "ids"))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """All columns, and ``decoded``: the bytes of the tokens."""
    columns = [c for c in encoded.columns if c != ids]
    source = encoded.select(*columns, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                decoded = [own.text(x or b"") for x in part.column(len(columns)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [*columns, ids, "decoded"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField("decoded", T.BinaryType())]))
