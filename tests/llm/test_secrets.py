import base64
import bz2
import gzip
import hashlib
import re
import urllib.parse
import zlib

import pytest
import zstandard
from ecospark.llm import secrets as s
from fixtures import SF, clashing, edge_rows, needs_data, no_docs

SECRET = 'password = "hunter2hunter2"'


def base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize("wrapped, opened", [
    (urllib.parse.quote(SECRET, safe=""), 1), (urllib.parse.quote(urllib.parse.quote(SECRET, safe=""), safe=""), 2),
    ("".join(f"\\u{ord(c):04x}" for c in SECRET), 1), (b64(SECRET.encode()), 1), (b64(gzip.compress(SECRET.encode())), 1),
    (b64(b64(zlib.compress(SECRET.encode())).encode()), 2), (b64(bz2.compress(SECRET.encode())), 1),
    (b64(zstandard.compress(SECRET.encode())), 1), (urllib.parse.quote(b64(SECRET.encode()) + "=="), None),
    (SECRET.replace("=", "&#61;"), 1), ("pass\\u0077ord = hunter2hunter2", 1), (b64(gzip.compress(gzip.compress(SECRET.encode()))), 1)])
def test_layers(wrapped, opened):
    text = "vorn é " + wrapped + " nach"
    before, every, n, _ = s.scan(text)
    assert before == base(text) and set(before) <= set(every)
    assert any(k == 0 and 7 <= a and b <= 7 + len(wrapped) for a, k, b in every)
    assert opened is None or n == opened
    assert "hunter2hunter2" not in s.redacted(text) and s.redacted(text).startswith("vorn é [SECRET]")


def test_spans_of_escapes_are_exact():
    text = "😀 x AKIA%41BCDEFGHIJKLMNOPQ y"
    start = text.index("AKIA")
    assert (start, 1, text.index(" y")) in s.scan(text)[1]


def test_cycles_and_bombs_end():
    assert s.scan("%25" * 50)[2] < 60
    bomb = b64(gzip.compress(b"a" * 5_000_000))
    assert s.scan(bomb, max_layer=1000)[3] == 1
    assert s.scan("\\ud800 \\udc00 &#0; %ff %00")[1] == []


def check(df, rows):
    want = []
    for i, t in rows:
        found = base(t or "")
        want.append((-1 if i is None else i, *(sum(x[1] == k for x in found) for k in range(3)),
                     hashlib.sha256(s.listed(found).encode()).hexdigest()))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_edge_rows(spark):
    rows = [r[:2] for r in edge_rows()]
    check(s.scan_documents(clashing(spark)), rows)
    assert s.scan_documents(no_docs(spark)).count() == 0
    kept = s.redact_documents(clashing(spark))
    assert kept.columns == clashing(spark).columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in rows)


@needs_data
def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(s.scan_documents(docs), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, zstandard.compress])
def test_all_members_are_read(pack):
    clean, half = pack(b"nothing here\n" * 40), len(SECRET) // 2
    assert s.scan(b64(clean))[1:] == ([], 1, 0)
    for data in (clean + pack(SECRET.encode()), pack(b"") + clean + pack(SECRET[:half].encode()) + pack(SECRET[half:].encode()),
                 clean + SECRET.encode(), clean + gzip.compress(SECRET.encode())):
        run = b64(data)
        assert s.scan(run)[1:] == ([(0, 0, len(run))], 1, 0) and s.redacted(run) == "[SECRET]"


def wrapped(data, width, end="\n"):
    run = b64(data)
    return end.join(run[k:k + width] for k in range(0, len(run), width))


CLEAR = b"".join(b"%d nothing to see %d\n" % (k * k, k ** 5) for k in range(60)) + SECRET.encode()


@pytest.mark.parametrize("width, end", [(64, "\n"), (76, "\r\n"), (76, "\n  "), (70, "\\n")])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, zstandard.compress])
def test_base64_over_lines(pack, width, end):
    run = wrapped(pack(CLEAR), width, end)
    for before, after in (("", ""), ("data: ", "."), ("-----BEGIN X-----\n", "\n-----END X-----\n"), ("some words\n", "\nthe next line")):
        _, every, _, unopened = s.scan(before + run + after)
        assert any(k == 0 and a <= len(before) and b >= len(before + run) for a, k, b in every), (before, every)
        assert not unopened and run[-8:] not in s.redacted(before + run + after)
    split = wrapped(b"x" * 40 + SECRET.encode() + b"y" * 40, 64)
    assert "[SECRET]" in s.redacted(split)


@pytest.mark.parametrize("prefix", ["path/", "key_", "id-", "a/b/c/", "key=", "x", "xy", "xyz"])
def test_base64_after_a_prefix(prefix):
    for data in (SECRET.encode(), gzip.compress(SECRET.encode()), bz2.compress(SECRET.encode())) + \
            ((zlib.compress(SECRET.encode()),) if prefix[-1] in "/_-=" else ()):
        assert "[SECRET]" in s.redacted(prefix + b64(data)), (prefix, data)


def test_stray_bytes_do_not_hide_a_layer():
    for stray in (b"\x00", b"\xff", b"\x01\xfe"):
        data = b"some text " + stray + b" " + SECRET.encode() + stray
        for run in (b64(data), b64(gzip.compress(data)), urllib.parse.quote(data, safe=""), "".join(f"&#{c};" for c in data),
                    "\\ud800" + "".join(f"\\u{c:04x}" for c in data) + "\\udc00"):
            assert "[SECRET]" in s.redacted(run), run
    every = s.scan("%ff%70assword = hunter2hunter2 %00")[1]
    assert every == [(3, 0, 30)]


def test_broken_members_are_counted():
    for pack in (gzip.compress, bz2.compress, zstandard.compress):
        run = b64(pack(CLEAR)[:-9])
        assert s.scan(run)[3] == 1 and s.scan(wrapped(pack(CLEAR)[:-9], 76))[3] == 1


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, zstandard.compress])
def test_content_beyond_the_bound_is_read(pack):
    noise = b"".join(b"line %d, nothing\n" % k for k in range(900))
    for hidden in (SECRET.encode(), b64(SECRET.encode()).encode(), wrapped(gzip.compress(SECRET.encode()), 64).encode()):
        for data in (noise + hidden, hidden + b"\n" + noise, noise + b"'" + hidden + b"'\n" + noise):
            for run in (b64(pack(data)), b64(gzip.compress(pack(data))), b64(pack(noise) + pack(data))):
                every, opened, unopened = s.scan("a " + run, max_layer=1000)[1:]
                assert (2, 0, 2 + len(run)) in every and opened > 10 and not unopened
                assert s.redacted("a " + run, max_layer=1000) == "a [SECRET]"
    for cut in range(900, 1100, 7):
        run = b64(pack(b"x," * (cut // 2) + b" " * (cut % 2) + SECRET.encode() + noise))
        assert (0, 0, len(run)) in s.scan(run, max_layer=1000)[1]


def test_runs_that_were_not_opened_are_replaced():
    run = b64(gzip.compress(b"z" * 50_000 + SECRET.encode()))
    assert s.scan(run, max_layer=1000)[3] == 1 and s.redacted(f"a {run} b", max_layer=1000) == "a [SECRET] b"
    plain = b64(gzip.compress(b"".join(b"line %d, nothing\n" % k for k in range(4000))))
    assert s.scan(plain, max_layer=1000)[1] == [] and s.redacted(plain, max_layer=1000) == plain


def test_escapes_that_were_escaped_again_take_one_pass():
    """A chain costs a few layers whatever its length, and what it hides is found with its place in the document."""
    import time
    for lead, unit, tail in (("%", "25", "61"), ("&", "amp;", "#97;"), ("\\", "u005c", "u0061"), ("\\", "x5C", "x61")):
        for depth in (1, 2, 3, 50_000):
            text = f"pre p{lead}{unit * depth}{tail}ssword = hunter2hunter2 end"
            began = time.time()
            base, every, opened, unopened = s.scan(text)
            assert not unopened and time.time() - began < 5
            start, end = text.index("p" + lead), text.index(" end")
            assert (start, 0, end) in every and opened <= 4, (lead, depth)


@pytest.mark.parametrize("codec", ["utf-16-le", "utf-16-be", "utf-16"])
def test_wide_text_in_base64(codec):
    run = base64.b64encode("the password = hunter2hunter2 is wide".encode(codec)).decode()
    text = f"see {run} end"
    assert (4, 0, 4 + len(run)) in s.scan(text)[1]
