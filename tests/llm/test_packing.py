import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tandem.llm import packing, tokens
from tandem.llm.catalog import op8_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def check_rows(rows, docs, tokenizer, size=1024):
    """Every id of every document in one piece, no sequence too long, offsets without gaps."""
    for i, text in docs:
        ids = ids_of(tokenizer, text, 0)
        own = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == i)
        assert own == [(s, len(p), zlib.crc32(p.tobytes()), len(ids)) for s in range(0, len(ids), size) if len(p := ids[s : s + size])]
    for number in {r["sequence_id"] for r in rows}:
        own = sorted((r["offset"], r["length"]) for r in rows if r["sequence_id"] == number)
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= size
    assert {r["sequence_id"] for r in rows} == set(range(len({r["sequence_id"] for r in rows})))


def test_query(spark, folder, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = op8_packing(spark, folder).collect()
    check_rows(rows, docs, tokenizer)
    assert sum(r["length"] for r in rows) > 0.95 * 1024 * len({r["sequence_id"] for r in rows})


def test_pieces_keep_the_tokenizer_ids(tokenizer):
    rng, encoder = random.Random(1), tokens.encoder(PATH)
    letters = [chr(c) for c in range(0x250)] + list(" \n\t'aeioZ019.,!_-") * 40 + ["日", "½", "<|endoftext|>", " ", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_new_pieces_go_to_the_model_alone(tokenizer, monkeypatch):
    """Every character that pieces can hold, alone and in pairs, gives the ids of the whole tokenizer."""
    encoder = tokens.Encoder(PATH)
    assert encoder.bare
    plain = [c for c in map(chr, range(0x250)) if tokens._PLAIN.fullmatch(c)]
    cases = plain + [a + b for a in " 'aé" for b in plain] + ["don't we've I'll", "naïve  \n\t x_1"]
    wanted = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in cases]
    monkeypatch.setattr(encoder, "whole", lambda text: pytest.fail("encoded whole"), raising=False)
    assert [encoder.encode(t) for t in cases] == wanted


def test_fill_is_shortest_pack_first():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(0, 60))]
        packs = []
        for n in sorted(lengths, reverse=True):
            fits = [p for p in packs if sum(p) + n <= 40]
            if fits:
                min(fits, key=sum).append(n)
            else:
                packs.append([n])
        made = packing.fill(Counter(lengths), 40)
        assert Counter(sum(p) for p, c in made for _ in range(c)) == Counter(map(sum, packs))
        assert Counter(n for p, c in made for n in p for _ in range(c)) == Counter(lengths)


def test_nulls_repeats_long_texts_and_no_rows(spark, tokenizer):
    docs = [(None, "one two"), (1, None), (2, ""), (3, "word " * 5000), (3, "word " * 5000), (4, "x")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int")
    out = packing.pack(frame, PATH, size=64, with_ids=True)
    assert out.columns == ["doc_id", "text", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
    rows = out.collect()
    assert sum(r["length"] for r in rows) == sum(len(ids_of(tokenizer, t, 0)) for _, t in docs)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack(frame.limit(0), PATH).collect() == []
