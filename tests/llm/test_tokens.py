"""Packing, byte-level BPE, WARC archives, licence scans, preference pairs."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlspike.llm import bpe, license_scan, packing, preference, warc
from marlspike.llm.tokens import WordTokens, read_ranks
from marlspike.session import scratch_path
from tests.llm.helpers import awkward, documents, prose, sentences

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
ODD = ["İstanbul ΣΑΣ it's I'LL ＦＵＬＬ ①② a\xa0b <|endoftext|>", "x'S ﬁ É́ é Ǆ ß\x0b\x1cz ŉ ſ ÷§ 12½", "  a  b \n c  'll don't \n\n y ", "word. (Word)"]


def ids(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def test_word_ids_equal_the_library():
    own, whole = WordTokens(WORDS), Tokenizer.from_file(WORDS)
    rnd = random.Random(1)
    texts = [*ODD, sentences(1, 200), *("".join(rnd.choice("aB. 'é\n1sß-") for _ in range(40)) for _ in range(300))]
    # letters whose lower or composed form is longer, before and after marks
    texts += ["".join(rnd.choice(["İ", "ı", "I", "É", "e\u0301", "ŉ", "ß", "ſ", "K", "a", "Z", ">", "|", "_", "'", ".", "<|", "7", " ", "\n", "\u0307"])
                      for _ in range(rnd.randrange(1, 9))) for _ in range(4000)]
    for t in texts:
        assert ids(own.ids(t.encode())) == whole.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("part_pieces", [1 << 15, 7])
def test_packing_keeps_every_token_once(spark, part_pieces):
    rows = [*awkward(), *((i, sentences(i, 30 + 17 * (i % 40))) for i in range(100, 180))]
    pieces = packing.token_pieces(documents(spark, rows, clashing=True), WORDS, capacity=512)
    out = packing.pack(pieces, capacity=512, part_pieces=part_pieces).toPandas()
    whole = Tokenizer.from_file(WORDS)
    want = []
    for i, t in rows:
        full = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(full), 512)):
            part = np.array(full[at:at + 512], dtype="<u4").tobytes()
            want.append((i if i is not None else -1, k, at, len(part) // 4, zlib.crc32(part)))
    got = out[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(-1).astype("int64").values.tolist()
    assert sorted(map(tuple, got)) == sorted(want)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.values == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all() and g.length.sum() <= 512
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 512) + (2 if part_pieces > 100 else 6)


def test_packing_of_nothing(spark):
    empty = packing.token_pieces(documents(spark, awkward()).limit(0), WORDS)
    assert packing.pack(empty).count() == 0


def test_lower_bound_never_exceeds_the_optimum():
    rnd = random.Random(3)

    def fits(sizes, bins, capacity):
        def put(i, room):
            if i == len(sizes):
                return True
            for k in sorted(set(room)):
                if k >= sizes[i]:
                    j = room.index(k)
                    room[j] -= sizes[i]
                    if put(i + 1, room):
                        return True
                    room[j] += sizes[i]
            return False
        return put(0, [capacity] * bins)

    for _ in range(60):
        sizes = sorted((rnd.randrange(1, 13) for _ in range(rnd.randrange(1, 9))), reverse=True)
        bound = packing.lower_bound(np.bincount(sizes, minlength=13), 12)
        optimum = next(b for b in range(1, 10) if fits(sizes, b, 12))
        bins, offsets, room = packing.best_fit_decreasing(np.array(sizes), 12)
        assert bound <= optimum <= len(room) and (room >= 0).all()
    assert packing.lower_bound(np.bincount([7, 7, 7], minlength=13), 12) == 3


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (300, 40)])
def test_byte_bpe_equals_the_library(spark, chunk, overlap):
    rows = [*awkward(), *enumerate(ODD, 100), (200, "a" * 3000), (201, "9 " * 900 + "\n" * 50 + "é" * 700), (202, prose(1, 4000))]
    own = tiktoken.Encoding("own", pat_str=RANKS[1], mergeable_ranks=read_ranks(RANKS[0]), special_tokens={})
    out = bpe.decode(bpe.encode(documents(spark, rows, clashing=True), *RANKS, chunk=chunk, overlap=overlap), *RANKS).collect()
    want = sorted((str(i), own.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r["row"]["doc_id"]), ids(r["ids"]), bytes(r["decoded"])) for r in out) == want
    assert bpe.encode(documents(spark, rows).limit(0), *RANKS).count() == 0


def test_byte_bpe_pieces_at_random():
    own, codec = tiktoken.Encoding("own", pat_str=RANKS[1], mergeable_ranks=read_ranks(RANKS[0]), special_tokens={}), bpe.codec(*RANKS)
    rnd = random.Random(3)
    for _ in range(4000):
        t = "".join(rnd.choice(["a", "B", " ", "  ", "\n", "é", "'s", "'", "1", "22", ".", "\t", " ", "ll", " ", "-", " "]) for _ in range(rnd.randrange(1, 14)))
        assert ids(codec.ids(t.encode())) == own.encode_ordinary(t), repr(t)


def test_warc_round_trip(spark):
    big = prose(1, 90_000)
    pages = [(3, "http://a", "<p>é</p>"), (1, "http://b c\n", "<p>é</p>"), (2, None, ""), (7, "u", ""), (5, "u", None), (4, "u", big), (4, "u", big), (None, "n", "<p>é</p>"), (None, "n", "only")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("stored", F.lit(0))
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df, path)
    got = warc.read_archives(spark, path).collect()
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    assert len(got) == len(pages) and all(r["digest_ok"] for r in got)
    want = []
    for i, _, html in pages:
        raw = (html or "").encode()
        own = first.get(html or "")
        kind = "response" if i == own else "revisit"
        want.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, own if kind == "revisit" else None, raw if kind == "response" else None))
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got), key=str) == sorted(want, key=str)
    empty = scratch_path(spark, "warc-none")
    warc.write_archives(df.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_warc_damage_is_found():
    good = warc.member(1, "u", b"payload", None)
    assert next(warc.records(good))["payload"] == b"payload"
    with pytest.raises(ValueError):
        list(warc.records(good[: len(good) // 2]))
    plain = zlib.decompress(good, 31)
    wrong = zlib.compressobj(6, zlib.DEFLATED, 31)
    assert not next(warc.records(wrong.compress(plain.replace(b"payload\r", b"pAyload\r")) + wrong.flush()))["digest_ok"]
    short = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        list(warc.records(short.compress(plain[:-5]) + short.flush()))


def test_license_counts_and_templates(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    rows = [*awkward(), (20, "x CC-BY y. All rights  reserved; all RIGHTS reserved"), (21, "General Public\nLicense cc by"), (22, "a " * 50 + mit.replace("hereby", "now hereby") + " b" * 40),
            (23, "permission granted software"), (24, "Released under the MIT License. Released under the MIT License."), (24, "Released under the MIT License. Released under the MIT License.")]
    got = {}
    for r in license_scan.scan(documents(spark, rows, clashing=True)).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == [(0, 0, None, None, "", "", 0.0)]
    assert got[20][0][:6] == (10, 3, 1, 7, "cc-by,reserved", "cc-by,reserved")
    assert got[21][0][:5] == (5, 2, 0, 3, "cc-by,gpl")
    assert got[22][0][5] == "mit" and got[22][0][6] > 0.75
    assert got[23][0][5] == "" and len(got[24]) == 2 and got[24][0][5:] == ("mit", 1.0)
    assert license_scan.scan(documents(spark, rows).limit(0)).count() == 0


def test_preference_pairs(spark):
    turn = lambda *x: [{"role": r, "text": t} for r, t in x]
    pairs = [
        (1, turn(("user", "hi"), ("assistant", "yo"), ("user", "é?"), ("assistant", "good")), turn(("user", "hi"), ("assistant", "yo"), ("assistant", "bad"))),
        (2, None, turn(("user", "a"))), (3, [], []), (4, turn(("user", None)), turn(("user", ""), (None, "z"))), (4, turn(("user", None)), turn(("user", ""), (None, "z"))),
    ]
    kind = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(pairs, f"pair_id long, chosen {kind}, rejected {kind}").withColumn("prompt", F.lit("x"))
    got = sorted(preference.format_pairs(df).collect(), key=lambda r: r["pair_id"])
    one = got[0]
    assert one["n_prompt_turns"] == 2 and one["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n"
    learned = lambda text, mask: [text[m["start"]:m["start"] + m["length"]] for m in mask]
    assert learned(one["chosen"], one["chosen_mask"]) == ["good<|end|>\n"] and learned(one["rejected"], one["rejected_mask"]) == ["bad<|end|>\n"]
    assert one["prompt"] + one["chosen"] == preference.render([(t["role"], t["text"]) for t in pairs[0][1]])[0]
    assert got[1]["chosen"] == "" and got[2]["same"] and got[3]["n_prompt_turns"] == 1 and got[3]["chosen_mask"] == [] and len(got) == 5
    none = spark.createDataFrame([(1, 0, "user", "x"), (None, 0, "assistant", "y"), (2, 0, "assistant", "z")], "conv_id long, turn long, role string, text string")
    assert preference.swapped_replies(none).count() == 0 and preference.swapped_replies(none.limit(0)).count() == 0
