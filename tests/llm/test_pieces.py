import hashlib

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as layout

from tandem.llm import catalog, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello  world\n x", " leading", "trailing ", "   ", "", "▁a ▁▁b", "日本語😀é", "\x00a\tb\r\n", "<s> <0x0A> </s>", "x" * 3000,
    "private \U000e0001 use", "ﬁne ①② ㍿ ｶﾞ", "a b　c", "word " * 2000,
]


def reference(path=PATH):
    return sentencepiece.SentencePieceProcessor(model_file=path)


def spans(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text.encode(), return_type="proto", num_threads=1).pieces]


def test_ids_and_spans_are_the_librarys():
    own, theirs = pieces.Codec(PATH), reference()
    assert own.by_word
    for text, (ids, begins, ends) in zip(TEXTS, own.encode([t.encode() for t in TEXTS])):
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist())) == spans(theirs, text)
    # Whole texts cut at once give the same as words cut apart.
    by_word = own.encode([t.encode() for t in TEXTS])
    own.by_word = False
    assert [x[0].tolist() for x in own.encode([t.encode() for t in TEXTS])] == [x[0].tolist() for x in by_word]


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
def test_normaliser_follows_the_compiled_map(rule, squeeze, prefix):
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    model = layout.ModelProto()
    model.ParseFromString(theirs.serialized_model_proto())
    own = pieces.Normaliser(model.normalizer_spec.precompiled_charsmap, prefix, False, squeeze, True)
    for text in [*TEXTS, "é　 x", "straße İ", "각 한국어"]:
        outcome, source = own(text.encode())
        want, offsets = theirs.normalize(text, with_offsets=True)
        assert outcome.decode() == want
        # The library counts characters; byte places fall on the same ones.
        starts = [len(outcome.decode()[:k].encode()) for k in range(len(want) + 1)]
        assert [len(text.encode()[: source[k]].decode()) for k in starts] == list(offsets)


def test_spans_through_a_map_with_rules(tmp_path):
    """A model with normalisation rules: ids as the library's, spans led back to the source."""
    model, rules = layout.ModelProto(), layout.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "rules.model"
    path.write_bytes(model.SerializeToString())
    own, theirs = pieces.Codec(str(path)), reference(str(path))
    for text, (ids, begins, ends) in zip(TEXTS, own.encode([t.encode() for t in TEXTS])):
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist())) == spans(theirs, text), text


def test_broken_bytes_count_as_lost_characters():
    own = pieces.Codec(PATH)
    (ids, begins, ends), (good, _, _) = own.encode([b"a\xff\xe6\x97b", "a���b".encode()])
    assert ids.tolist() == good.tolist() and ends[-1] == 5
    assert own.decode([ids]) == ["a���b"]


def test_operator_edge_rows(spark):
    rows = [(1, "two words", "x", "q"), (2, None, "y", None), (None, "", "z", "q"), (1, "two words", "x", "q"), (5, "long " * 300_000, "w", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, `odd.name` string")
    out = pieces.encode_texts(docs, PATH)
    assert out.columns == ["doc_id", "text", "odd.name", "ids", "begins", "ends", "decoded"]
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert out.count() == 5 and got[2, None]["ids"] == [] and got[2, None]["decoded"] == "" and got[None, ""]["ids"] == []
    assert got[1, "two words"]["ids"] == reference().encode("two words")
    whole = got[5, "long " * 300_000]
    assert whole["ids"] == reference().encode("long " * 300_000) and whole["ends"][-1] == 1_500_000
    assert pieces.encode_texts(docs.limit(0), PATH).collect() == []


def test_query_against_the_library(spark, folder):
    theirs = reference()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = catalog.op11_pieces(spark, folder).collect()
    assert len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = theirs.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids))) and r["decoded_sha256"] == sha(theirs.decode(ids))
