"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters, everything else to a space. Every 2- and
3-gram with a letter is hashed to one of ``2**BITS`` buckets; training sums bucket
counts per language in Spark, so that the driver only ever sees the count matrix
(at most ``MAX_LANGS`` x ``2**BITS`` cells). The log-probability matrix is
broadcast; tasks score Arrow batches in numpy. Of equal scores the language first in
alphabetical order wins.

A text that is null, or has no letter, is ``und`` with score 0. So is every text if
no row could be learned from. Repeated rows are learned and scored as often as they
stand; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marlspike.llm import bytetext as B

BITS = 16
#: The matrix is broadcast, so the number of languages must be bounded.
MAX_LANGS = 512
SMOOTHING = 0.5
UND = "und"
_fold: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    global _fold
    if _fold is None:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _fold = table
    return _fold


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every character n-gram, and the number of letters of each text."""
    codes = fold_table()[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)]
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]  # offsets in characters
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(heads))
    letter = codes != 32
    letters = np.bincount(text[letter], minlength=len(offsets) - 1)
    h = codes.astype(np.uint64)
    out = []
    for n in (2, 3):
        m = len(h) - n + 1
        if m <= 0:
            continue
        keep = text[:m] == text[n - 1:]
        some = letter[:m].copy()
        for j in range(1, n):
            some |= letter[j:j + m]
        keep &= some
        acc = h[:m] + B.U(n << 32)
        for j in range(1, n):
            acc = acc * B.U(0x9E3779B97F4A7C15) + h[j:j + m]
        out.append(((B.mix(acc) >> B.U(64 - BITS)).astype(np.int64)[keep], text[:m][keep]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, letters
    return np.concatenate([b for b, _ in out]), np.concatenate([t for _, t in out]), letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, bucket, n); bucket -1 counts texts."""
    sums: dict[str, np.ndarray] = {}

    def flush():
        for lang, v in sums.items():
            hit = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit)), pa.array(hit - 1, pa.int32()), pa.array(v[hit], pa.int64())], ["lang", "bucket", "n"])
        sums.clear()

    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for first, last, data, offsets in B.slices(batch.column(0)):
            bucket, text, letters = gram_buckets(data, offsets)
            here = langs[first:last]
            for lang in sorted(set(here)):
                own = here == lang
                v = sums.setdefault(lang, np.zeros(2**BITS + 1, dtype=np.int64))
                v[0] += int((own & (letters > 0)).sum())
                v[1:] += np.bincount(bucket[own[text]], minlength=2**BITS)
            if len(sums) > 32:
                yield from flush()
    yield from flush()


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log-probability matrix) from all rows with a text and a language."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    counts = (rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
              .mapInArrow(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    got = counts.toArrow()
    names = got["lang"].to_pylist()
    langs = sorted(set(names))
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} languages; the broadcast matrix holds {MAX_LANGS} at most")
    place = {x: i for i, x in enumerate(langs)}
    table = np.zeros((2**BITS, len(langs)))
    prior = np.zeros(len(langs))
    at = np.array([place[x] for x in names], dtype=np.int64)
    bucket, n = np.asarray(got["bucket"]), np.asarray(got["n"])
    texts = bucket < 0
    prior[at[texts]] = n[texts]
    table[bucket[~texts], at[~texts]] = n[~texts]
    if langs:
        prior = np.log((prior + 1) / (prior + 1).sum())
        table = np.log((table + SMOOTHING) / (table + SMOOTHING).sum(axis=0))
    return langs, prior, table.astype(np.float32)


def score_texts(data: np.ndarray, offsets: np.ndarray, langs: list[str], prior: np.ndarray, table: np.ndarray) -> tuple[list[str], np.ndarray]:
    n = len(offsets) - 1
    bucket, text, letters = gram_buckets(data, offsets)
    if not langs:
        return [UND] * n, np.zeros(n)
    sums = np.stack([np.bincount(text, weights=table[bucket, i], minlength=n) for i in range(len(langs))], axis=1) + prior
    best = sums.argmax(axis=1)
    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
    share = odds.max(axis=1) / odds.sum(axis=1)
    none = letters == 0
    return [UND if z else langs[b] for b, z in zip(best, none)], np.where(none, 0.0, share)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """The rows of ``docs`` as one struct column ``row``, with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    fields = packed.schema["row"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, _, data, offsets in B.slices(batch.column(1)):
                some, share = score_texts(data, offsets, *shared.value)
                names += some
                scores.append(share)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                ["row", "lang_pred", "score"])

    return packed.mapInArrow(run, T.StructType([
        T.StructField("row", fields), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Documents whose language is found: no letter, or a score below ``least_score``, goes. Learns from the rows with ``lang``."""
    found = predict(docs, fit(docs))
    return found.filter((F.col("lang_pred") != UND) & (F.col("score") >= least_score)).select("row.*")
