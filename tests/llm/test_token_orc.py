import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from ecospark.llm import token_orc as t
from ecospark.llm.common import scratch_path
from fixtures import SF, clashing, edge_rows, needs_data, no_docs

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LETTERS = list(" \t\n\x1cab's1é日😀.<|>É̈İΣ́") + ["<|startoftext|>", " ", "don't ", "ΑΣ ", "WORD, "]


def test_words_equal_the_library():
    rng = random.Random(0)
    texts = ["", " "] + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(2500)]
    enc = t.encoder(TOKENIZER)
    assert enc.apart
    for again in range(2):
        got = [np.frombuffer(x, np.uint32).tolist() for x in enc.encode_many(texts)]
        assert got == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_bytes_of_words_equal_the_library():
    rng = random.Random(1)
    marks = ["\0", "\x01", "\x1d", "\x7f", "\x85", "\xa0", "\u2003", "\u3000", "\ufeff", "H\u0331", "h\u0331", "\u0308", "ﬁ", "K", "'", "<|endoftext|>"]
    long = ["x" * n + c for n in (7, 8, 15, 16, 40, 63, 64) for c in "aB"] + ["日本語" * 5, "Größe", "größe", "12:30"]
    texts = ["", "join", "ed", " ", "\t"] + ["".join(rng.choice(LETTERS[:3] + long + marks) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    enc = t.WordEncoder(TOKENIZER)
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode_many(texts)] == want
    flat, size = enc.encode_column(pa.array(["cut off", *texts]).slice(1))  # of any string type, from any offset
    assert flat.tolist() == [i for x in want for i in x] and size.tolist() == [len(x) for x in want]


def test_a_word_is_looked_up_once_a_batch(monkeypatch):
    looked, rows = [], t.IdTable.rows
    monkeypatch.setattr(t.IdTable, "rows", lambda self, words: rows(self, looked.extend(words := list(words)) or words))
    enc = t.WordEncoder(TOKENIZER)
    texts = ["the words' größe of one text and the words' größe of a considerably-longer-hyphenated-größe one"] * 500
    got = enc.encode_many(texts)
    assert got[0].tolist() == got[-1].tolist() == enc.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert len(looked) < 100


def test_words_met_again_are_kept():
    def numbers(words):
        data = np.frombuffer("".join(words).encode(), np.uint8)
        size = np.array([len(w.encode()) for w in words])
        return table.numbers(data, np.cumsum(size) - size, size)

    table, words = t.WordTable(), ["a", "b", "eightbyt", "eightbytes and more", "eightbytes and less", "eightbytes and more of it", "x" * 70, "x" * 70]
    first = numbers([*words, "a"])
    assert first[0] == first[-1] and len(set(first.tolist())) == len(words)  # words over COMPARED bytes are never compared
    table.put(first[:-1], np.arange(8, dtype=np.uint32).repeat(2), np.full(8, 2))
    assert (numbers(["b", "eightbytes and less"]) == first[[1, 4]]).all()
    table.forget(100)
    kept = numbers(words)
    assert table.size[kept].tolist() == [-1, 2, 2, -1, 2, -1, -1, -1]  # "eightbyt" is what a kept word begins with
    assert table.ids(numbers(["eightbytes and less", "b"]))[0].tolist() == [4, 4, 1, 1]
    table.forget(1)
    kept = numbers(words)
    assert (table.size[kept] == -1).all()


def test_tokenizers_of_other_kinds(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    rng = random.Random(2)
    texts = ["", *("".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(300))]
    for name, pre, apart in (("never.json", None, False), ("space.json", pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]), True)):
        tokenizer = Tokenizer.from_file(TOKENIZER)
        tokenizer.pre_tokenizer = pre or pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        tokenizer.save(str(tmp_path / name))
        enc = t.WordEncoder(str(tmp_path / name))
        assert enc.apart == apart and not enc.latin
        assert [x.tolist() for x in enc.encode_many(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_the_memory_is_trimmed(monkeypatch):
    monkeypatch.setattr(t, "CACHE_WORDS", 20)
    enc = t.WordEncoder(TOKENIZER)
    for k in range(6):
        texts = [f"Word{i} erth, number{i * k} the" for i in range(40)]
        got = [np.frombuffer(x, np.uint32).tolist() for x in enc.encode_many(texts)]
        assert got == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def index_of(rows, end=2):
    tokenizer = t.encoder(TOKENIZER).tokenizer
    out, start = [], 0
    for i, x in sorted(rows):
        ids = np.array([*tokenizer.encode(x or "", add_special_tokens=False).ids, end], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@needs_data
def test_documents_through_files(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in t.encode_and_index(docs, TOKENIZER).collect())
    assert got == index_of([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows_and_pruned_reads(spark):
    path = scratch_path(spark, "test-orc")
    rows = [(-1 if i is None else i, x or "") for i, x, *_ in edge_rows()]
    docs = clashing(spark).fillna({"doc_id": -1})
    got = sorted(tuple(r) for r in t.encode_and_index(docs, TOKENIZER, path=path).collect())
    want = index_of(rows)
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((r[0], r[2], r[3]) for r in want)
    total = 0
    for r in sorted(got, key=lambda r: r[1]):  # starts are gapless whatever the order of equal ids
        assert r[1] == total
        total += r[2]
    one = t.read_tokens(spark, path).where("doc_id = 8")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,8)]" in plan
    assert t.encode_and_index(no_docs(spark), TOKENIZER).count() == 0
