import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from ecospark.llm import sentencepiece_codec as c
from fixtures import SF, clashing, edge_rows, needs_data, no_docs
from sentencepiece import sentencepiece_model_pb2 as proto

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = list(" ▁ab\né日😀.<0x1>\x01") + ["ﬁ", "①", "Ａ", "　", "é", "​", "\t", "㍿"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["", " ", "  a  b ", "▁x ▁▁ y", "<s> </s> <unk>", "\x00b"] + \
        ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def same(codec, library, texts):
    for text, (ids, start, end, joined) in zip(texts, codec.encode_many(texts)):
        ref = library.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in ref.pieces], text
        assert list(zip(start.tolist(), end.tolist())) == [(p.begin, p.end) for p in ref.pieces], text
        assert joined == ",".join(str(p.id) for p in ref.pieces)
        assert codec.decode(ids) == library.decode(ids.tolist())


def test_public_model():
    same(c.codec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL), texts(500))


@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("dummy", [True, False])
def test_compiled_character_map(squeeze, dummy):
    """The library's own map of compatibility forms, put into the public model in memory."""
    spec, rules = proto.ModelProto(), proto.ModelProto()
    spec.ParseFromString(open(MODEL, "rb").read())
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    spec.normalizer_spec.CopyFrom(rules.normalizer_spec)
    spec.normalizer_spec.remove_extra_whitespaces, spec.normalizer_spec.add_dummy_prefix = squeeze, dummy
    spec.normalizer_spec.escape_whitespaces = True
    model = spec.SerializeToString()
    codec = c.Codec(model)
    assert codec.normalize.map.units
    same(codec, sentencepiece.SentencePieceProcessor(model_proto=model), texts(400, 2))


def test_the_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(c, "CACHE_SEGMENTS", 10)
    codec = c.Codec(open(MODEL, "rb").read())
    many = [f"word{i} is number{i * 7}" for i in range(300)] * 2
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [r[0].tolist() for r in codec.encode_many(many)] == library.encode(many)
    assert [r[0].tolist() for r in codec.encode_many(many[:5])] == library.encode(many[:5])


def digests(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "")
        out.append((-1 if i is None else i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out)


def collected(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect())


def test_edge_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert collected(c.round_trip(clashing(spark), MODEL)) == digests(library, [r[:2] for r in edge_rows()])
    assert c.round_trip(no_docs(spark), MODEL).count() == 0


@needs_data
def test_documents_and_decoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert collected(c.round_trip(docs, MODEL)) == digests(library, rows)
    encoded = c.encode_documents(docs, MODEL)
    back = {r.doc_id: r.text for r in c.decode_documents(encoded, MODEL).collect()}
    assert back == dict(rows)
    for r in encoded.limit(20).collect():
        data = dict(rows)[r.doc_id].encode()
        assert r.ends[-1] == len(data) and all(a <= b for a, b in zip(r.starts, r.ends))
        assert b"".join(data[a:b] for a, b in zip(r.starts, r.ends)) == data
