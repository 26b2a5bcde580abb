"""Preference formatting: a prompt rendered once, and two masked completions.

The prompt of a pair is the longest run of leading turns that the chosen and the
rejected conversation share (role and text). What is left of each is rendered as its
completion; its mask lists the spans, in characters of the completion, that a model
learns from: the texts of assistant turns with their end marks.

A null role or text counts as empty. A conversation that is null or empty has no turns.
If one conversation begins with all of the other, the other's completion is empty; equal
conversations give two empty completions and ``same`` true. Repeated pairs are formatted
as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marlspike.operators.series import number_rows

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def shared_turns(chosen: list[tuple[str, str]], rejected: list[tuple[str, str]]) -> int:
    n = 0
    for a, b in zip(chosen, rejected):
        if a != b:
            break
        n += 1
    return n


def render(turns: list[tuple[str, str]]) -> tuple[str, list[dict]]:
    """The turns as one text, and the spans to learn from."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head = OPEN + role + CLOSE
        if role == LEARNED_ROLE:
            spans.append({"start": at + len(head), "length": len(text) + len(END)})
        out.append(head + text + END)
        at += len(out[-1])
    return "".join(out), spans


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pair_id, n_prompt_turns, same, prompt, chosen, chosen_mask, rejected, rejected_mask``.

    ``pairs``: ``pair_id, chosen, rejected``, the latter arrays of structs with role and text.
    """
    kind = pairs.schema["pair_id"].dataType.simpleString()
    mask = "array<struct<start:bigint,length:bigint>>"
    arrow_mask = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    names = ["pair_id", "n_prompt_turns", "same", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]
    kinds = [pa.int64(), pa.bool_(), pa.string(), pa.string(), arrow_mask, pa.string(), arrow_mask]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part, out = batch.slice(first, 256), []
                for sides in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    a, b = ([(t["role"] or "", t["text"] or "") for t in side or ()] for side in sides)
                    n = shared_turns(a, b)
                    out.append((n, a == b, render(a[:n])[0], *render(a[n:]), *render(b[n:])))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return pairs.select("pair_id", "chosen", "rejected").mapInArrow(
        run, f"pair_id {kind}, n_prompt_turns long, same boolean, prompt string, chosen string, chosen_mask {mask}, rejected string, rejected_mask {mask}")


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations (conv_id, turn, role, text): the last assistant turn against a mismatched one.

    A conversation up to its last assistant turn is chosen; rejected is the same with that
    turn replaced by the last assistant turn of the conversation that follows in id order
    (the first follows the last). Turns sort by turn, role, text, nulls first; rows without
    conv_id and conversations without an assistant turn are left out; a lone one has no pair.
    """
    turns = conversations.select(*[conversations[c].alias(c) for c in ("conv_id", "turn", "role", "text")]).filter(F.col("conv_id").isNotNull())
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    stop = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == LEARNED_ROLE, i)))
    plain = lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))
    whole = whole.filter(stop.isNotNull()).select("conv_id", F.transform(F.slice("turns", 1, stop + 1), plain).alias("turns"))
    numbered = number_rows(whole, ["conv_id"])
    n = numbered.count()
    replies = numbered.select(F.pmod(F.col("rn") - 1, F.lit(max(n, 1))).alias("rn"), F.element_at("turns", -1).alias("other"))
    return numbered.join(replies, "rn").filter(F.lit(n > 1)).select(
        F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", 1, F.size("turns") - 1), F.array("other")).alias("rejected"))
